"""SimHash near-deduplication by bit-sliced comparison.

Two fingerprints that differ in at most ``radius`` of 64 bits agree in at least ``agree`` of ``radius + agree`` blocks of
bits. For each choice of that many blocks, fingerprints that agree there share a bucket, so no link is missed. Within
buckets, bits are stored vertically, one number per bit position with a lane for each fingerprint; the distances of many
lanes are counted at once by bitwise adders, and a comparison ends as soon as every lane exceeds the radius.
Equal fingerprints are one from the start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import components, partitions, slices, stored, text_or_empty

BITS = 64
SEED = 42
# Rows of a bucket that one task compares with as many others; a larger bucket is split into pairs of such parts.
LANES = 8192
_SHINGLES = 1 << 16


def fingerprint(text: str, shingle: int) -> int:
    """The 64-bit SimHash of the word shingles of ``text``: a bit is 1 if set in over half of their XXH64 hashes."""
    words = b" ".join(text.encode().lower().split())  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts, ends = [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(words)]
    ends = ends[min(shingle, len(ends)) - 1 :]
    counts, digest = np.zeros(BITS, dtype=np.int64), xxhash.xxh64_digest
    for i in range(0, len(ends), _SHINGLES):
        part = zip(starts[i : i + _SHINGLES], ends[i : i + _SHINGLES])  # more starts than ends
        hashes = b"".join([digest(words[a:b], SEED) for a, b in part])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(ends)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fp``, the fingerprint as a signed long, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(run, "id long, fp long")


def planes(values: np.ndarray) -> list[int]:
    """The bit positions of ``values`` (uint64) as numbers: bit i of plane j is bit j of value i."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    return [int.from_bytes(row.tobytes(), "little") for row in packed]


def within(bits: list[int], shift: int, lanes: int, radius: int) -> int:
    """Of the lanes in the mask ``lanes``, those whose value differs in at most ``radius`` bits from the one ``shift``
    lanes further on.

    Counters start so that they overflow above the radius. Two planes and the lowest counter go into one carry-save
    adder; its carry ripples through the higher counters. Lanes that overflowed stay out.
    """
    width = max(1, radius.bit_length())
    begin = (1 << width) - 1 - radius
    counter = [lanes if begin >> i & 1 else 0 for i in range(width)]
    over = 0
    for low, high in zip(bits[::2], bits[1::2], strict=True):
        a, b = (low ^ (low >> shift)) & lanes, (high ^ (high >> shift)) & lanes
        either = a ^ b
        carry = (a & b) | (either & counter[0])
        counter[0] ^= either
        for i in range(1, width):
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        over |= carry
        if over == lanes:
            return 0
    return lanes & ~over


def _mask(lanes: np.ndarray) -> int:
    return int.from_bytes(np.packbits(lanes, bitorder="little").tobytes(), "little")


def bucket_links(values: np.ndarray, bucket: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs of places that link all values within ``radius`` in the same bucket: a spanning forest, not all pairs.

    ``bucket`` is sorted. All lanes are compared at once with the lane 1, 2, 3, ... further on, as long as both are in
    one bucket and aren't linked already. Whenever that distance doubles, buckets that are done leave the planes.
    """
    links: list[tuple[int, int]] = []
    place = np.arange(len(values))
    group = place.copy()  # the first place each is linked with so far
    shift = 1
    while len(place):
        starts = np.flatnonzero(np.r_[True, bucket[place][1:] != bucket[place][:-1]])
        sizes = np.diff(np.r_[starts, len(place)])
        own = group[place]
        mixed = np.maximum.reduceat(own, starts) != np.minimum.reduceat(own, starts)
        place = place[np.repeat((sizes > shift) & mixed, sizes)]
        if not len(place):
            break
        bits, named = planes(values[place]), bucket[place]
        for s in range(shift, 2 * shift):
            own = group[place]
            lanes = np.zeros(len(place), dtype=bool)
            lanes[:-s] = (named[:-s] == named[s:]) & (own[:-s] != own[s:])
            mask = _mask(lanes)
            near = within(bits, s, mask, radius) if mask else 0
            while near:
                lane = (near & -near).bit_length() - 1
                near &= near - 1
                a, b = int(place[lane]), int(place[lane + s])
                if group[a] != group[b]:
                    links.append((a, b))
                    low, high = sorted((group[a], group[b]))
                    same = place[named == named[lane]]
                    group[same[group[same] == high]] = low
        shift *= 2
    return links


def masks(radius: int, agree: int) -> list[int]:
    """For each choice of ``agree`` of ``radius + agree`` blocks of bits, the bits of those blocks, as signed longs."""
    ends = [BITS * i // (radius + agree) for i in range(radius + agree + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    every = [sum(some) for some in combinations(blocks, agree)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in every]


def link_fingerprints(distinct: DataFrame, radius: int, agree: int = 3) -> DataFrame:
    """Links between distinct fingerprints ``fp`` that differ in at most ``radius`` bits: columns ``a`` and ``b``.

    They connect what is connected; pairs that are linked through others may be left out.
    """
    tables = [F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks(radius, agree))]
    keyed = distinct.select("fp", F.explode(F.array(*tables)).alias("at")).select("fp", "at.*")
    shared = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / LANES).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    # Spark sizes both sides as the table before the explode, and would broadcast some 35 rows for each fingerprint.
    dealt = (
        keyed.join(shared.hint("merge"), ["table", "key"])
        .withColumn("parts", parts)
        .withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), F.col("parts") - 1))})
        .select("table", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
    )
    bucket = ["table", "key", "low", "high"]
    dealt = dealt.repartition(partitions(distinct), *bucket).sortWithinPartitions(*bucket)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None

        def links(rows: np.ndarray) -> pa.RecordBatch:
            starts = np.r_[True, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)]
            pairs = np.array(bucket_links(rows[:, 4].view(np.uint64), np.cumsum(starts), radius), dtype=np.int64).reshape(-1, 2)
            ends = [pa.array(rows[pairs[:, i], 4], pa.int64()) for i in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in (*bucket, "fp")], axis=1)
            rows = rows if held is None else np.concatenate([held, rows])
            # The last bucket may go on in the next batch; it has at most two parts' rows.
            last = len(rows) - int((rows[::-1, :4] == rows[-1, :4]).all(axis=1).cumprod().sum())
            if last:
                yield links(np.ascontiguousarray(rows[:last]))
            held = rows[last:]
        if held is not None:
            yield links(np.ascontiguousarray(held))

    return dealt.mapInArrow(compare, "a long, b long")


def simhash_groups(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    Words are what stands between ASCII white space, A-Z in lower case. Shingles count as often as they occur; a text
    of fewer words is one shingle, and one without words has fingerprint zero. Documents are linked when their
    fingerprints differ in at most ``radius`` bits; ``component_id`` is the least id reachable. Null texts are empty, a
    null id is never the least unless the whole component has no other, and rows that repeat an id count each. An empty
    table gives an empty result; other columns are not looked at.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("id"))
    groups = components(link_fingerprints(distinct, radius), "a", "b", "fp", "root")
    least = groups.join(distinct, "fp").groupBy("root").agg(F.min("id").alias("component_id"))
    linked = groups.join(least, "root").select("fp", "component_id")
    every = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "id").alias("component_id"))
    every = stored(every, "fingerprint-groups")  # so that the join can split a fingerprint that very many rows have
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(every, "fp").select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), "component_id")

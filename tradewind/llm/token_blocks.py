"""Token ids in binary files of patched frame-of-reference blocks.

A file is a row of segments. Each holds some documents: a header, their ids and lengths, then the token ids in blocks of
256. A block subtracts its minimum and packs the differences at one bit width, the least that holds a given share of
them; those that need more bits stand in an exception list with their places. The segment's index has the byte where
each block starts, so that one block can be read without those before it.

Segment, all little-endian::

    magic     4 bytes  b"PFR1"
    numbers   uint64   bytes of the segment, order of its file, documents, token ids, blocks
    documents int64 ids, uint8 1 where the id is present, uint32 numbers of token ids
    index     uint64   block starts in the payload, and its end
    payload   per block: uint32 minimum, uint8 width, uint16 exceptions,
              packed differences (bits from the low end), uint8 places and uint32 values of the exceptions

Segments are separated by one line feed, which Spark's text writer puts behind each row. Files are written and read by
Spark, so they can lie in any store that it reaches.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import partitions, slices, stored, text_or_empty
from tradewind.llm.encoding import encoder

BLOCK = 256
MAGIC = b"PFR1"
_HEAD = struct.Struct("<4s5Q")
_BLOCK_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("odd", "<u2")])


def _bits(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values as rows of bytes: each value's ``width`` low bits, one after another from the low end.

    64 values fill ``width`` words of 64 bits; value by value, all rows are shifted into place at once.
    """
    if not width:
        return np.zeros((len(values), 0), np.uint8)
    columns = np.ascontiguousarray(values.reshape(-1, 64).T.astype(np.uint64)) & np.uint64((1 << width) - 1)
    words = np.zeros((width, columns.shape[1]), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[word] |= columns[i] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(values), -1)


def _values(rows: np.ndarray, width: int) -> np.ndarray:
    """The values that ``_bits`` packed."""
    words = np.ascontiguousarray(rows.reshape(-1, 8 * width).view("<u8").T)
    columns = np.empty((64, words.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[word + 1] << np.uint64(64 - shift)
        columns[i] = value & mask
    return np.ascontiguousarray(columns.T).reshape(-1, BLOCK)


def pack_blocks(ids: np.ndarray, share: float = 0.9) -> tuple[bytes, np.ndarray]:
    """The payload of ``ids`` (uint32) and the starts of its blocks, with the end. ``share`` chooses the widths."""
    if not len(ids):
        return b"", np.zeros(1, "<u8")
    blocks = -(-len(ids) // BLOCK)
    padded = np.full(blocks * BLOCK, ids[-1], dtype=np.uint32)
    padded[: len(ids)] = ids
    padded = padded.reshape(blocks, BLOCK)
    least = padded.min(axis=1)
    over = padded - least[:, None]
    place = int(np.ceil(share * BLOCK)) - 1
    width = np.frexp(np.partition(over, place, axis=1)[:, place].astype(np.float64))[1]
    odd = over >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    heads = np.zeros(blocks, _BLOCK_HEAD)
    heads["least"], heads["width"], heads["odd"] = least, width, odd.sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        at = np.flatnonzero(width == w)
        for i, row in zip(at.tolist(), _bits(over[at], w), strict=True):
            packed[i] = row.tobytes()
    places, values = np.nonzero(odd)[1].astype(np.uint8), over[odd].astype("<u4")
    counts, begin, out = heads["odd"].tolist(), 0, []
    for head, low, n in zip(heads, packed, counts, strict=True):
        end = begin + n
        out.append(head.tobytes() + low + places[begin:end].tobytes() + values[begin:end].tobytes())
        begin = end
    return b"".join(out), np.cumsum([0, *map(len, out)], dtype="<u8")


def unpack_blocks(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """A row of 256 ids for each of the blocks at ``starts``. Behind a segment's last id stands its repetition."""
    view, at = memoryview(payload), starts.astype(np.int64).tolist()
    size = _BLOCK_HEAD.itemsize
    heads = np.frombuffer(b"".join([view[x : x + size] for x in at]), _BLOCK_HEAD)
    out = np.zeros((len(at), BLOCK), dtype=np.uint32)
    for w in filter(None, np.unique(heads["width"]).tolist()):
        some = np.flatnonzero(heads["width"] == w)
        packed = b"".join([view[at[i] + size : at[i] + size + BLOCK // 8 * w] for i in some.tolist()])
        out[some] = _values(np.frombuffer(packed, np.uint8).reshape(-1, BLOCK // 8 * w), w)
    odd = np.flatnonzero(heads["odd"])
    counts = heads["odd"][odd].astype(np.int64)
    begins = [at[i] + size + BLOCK // 8 * w for i, w in zip(odd.tolist(), heads["width"][odd].tolist(), strict=True)]
    ends = list(zip(begins, counts.tolist(), strict=True))
    places = np.frombuffer(b"".join([view[x : x + n] for x, n in ends]), np.uint8)
    values = np.frombuffer(b"".join([view[x + n : x + 5 * n] for x, n in ends]), "<u4")
    out[np.repeat(odd, counts), places] = values
    return out + heads["least"][:, None]


def segment(file: int, docs: list[int | None], ids: list[bytes], share: float = 0.9) -> bytes:
    """A segment of the documents ``docs`` with their token ids, as little-endian unsigned 32-bit bytes."""
    every = np.frombuffer(b"".join(ids), "<u4")
    payload, starts = pack_blocks(every, share)
    body = b"".join(
        (
            np.array([0 if d is None else d for d in docs], "<i8").tobytes(),
            np.array([d is not None for d in docs], np.uint8).tobytes(),
            np.array([len(x) // 4 for x in ids], "<u4").tobytes(),
            starts.tobytes(),
            payload,
        )
    )
    return _HEAD.pack(MAGIC, _HEAD.size + len(body), file, len(docs), len(every), len(starts) - 1) + body


def read_segments(content: bytes) -> Iterator[tuple[int, list[int | None], np.ndarray, np.ndarray]]:
    """Of each segment of a file: the order of its file, the documents, all their token ids, and how many each has."""
    at = 0
    while at < len(content):
        magic, size, file, docs, n, blocks = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {at}")
        x = at + _HEAD.size
        names = np.frombuffer(content, "<i8", docs, x).tolist()
        present = np.frombuffer(content, np.uint8, docs, x := x + 8 * docs).tolist()
        lengths = np.frombuffer(content, "<u4", docs, x := x + docs).astype(np.int64)
        starts = np.frombuffer(content, "<u8", blocks + 1, x := x + 4 * docs)
        payload = content[x + 8 * (blocks + 1) : at + size]
        ids = unpack_blocks(payload, starts[:-1]).reshape(-1)[:n]
        yield file, [d if p else None for d, p in zip(names, present, strict=True)], ids, lengths
        at += size + 1


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    share: float = 0.9,
) -> None:
    """Encode every whole text and write it in ascending order of the id, a file for each shuffle partition.

    Null ids come first and null texts are empty: they have the end id alone. Rows that repeat an id are all written, in
    any order among themselves. Other columns are not written.
    """
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    ordered = rows.repartitionByRange(partitions(docs), F.asc_nulls_first("id")).sortWithinPartitions(
        F.asc_nulls_first("id")
    )
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, own = TaskContext.get().partitionId(), encoder(tokenizer)
        for batch in slices(batches, "text"):
            ids = [x + end for x in own.encode(batch.column("text").to_pylist())]
            made = segment(file, batch.column("id").to_pylist(), ids, share)
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["segment"])

    write_segments(ordered.mapInArrow(write, "segment binary"), path)


def write_segments(segments: DataFrame, path: str) -> None:
    """One file for each partition. The cast takes the bytes as they are, and so does the writer."""
    segments.select(F.col("segment").cast("string").alias("value")).write.text(path, compression="none")


def read_tokens(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """The documents of a folder of token files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids``.

    ``start`` counts the token ids of all documents before. Without ``ids`` only their checksum is returned.
    """
    kind = "file long, place long, doc_id long, first long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], pa.int64()) for f in kind.split(", ")])
        for content in (c for batch in batches for c in batch.column("content")):
            first = place = 0
            for file, docs, found, lengths in read_segments(content.as_py()):
                ends = np.cumsum(lengths)
                raw = memoryview(found.astype("<u4", copy=False).tobytes())
                bounds = pairwise([0, *(4 * ends).tolist()])
                columns = [
                    np.full(len(docs), file),
                    np.arange(place, place + len(docs)),
                    pa.array(docs, pa.int64()),
                    first + ends - lengths,
                    lengths,
                    [zlib.crc32(raw[a:b]) for a, b in bounds],
                ]
                arrays = [pa.array(c, pa.int64()) for c in columns]
                if ids:
                    offsets = pa.array(np.r_[0, ends], pa.int32())
                    arrays.append(pa.ListArray.from_arrays(offsets, pa.array(found.astype(np.int64))))
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema.append(pa.field("ids", pa.list_(pa.int64()))))
                else:
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)
                first, place = first + int(ends[-1]), place + len(docs)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    found = files.mapInArrow(read, kind + (", ids array<long>" if ids else ""))
    found = stored(found, "tokens-read")
    totals = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    offsets = totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    columns = ["doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(offsets, "file").select(*columns, *(["ids"] if ids else []))

"""Best-fit packing of documents into sequences by bin completion.

Documents are encoded and cut in Spark. What the packing has to decide depends on the pieces' lengths alone, and there
are at most as many lengths as a sequence has tokens: so the pieces of each length are counted, bin completion works on
these counts, whatever the number of pieces, and its plan says how many sequences take which lengths. The pieces then
find their sequences in Spark, by their rank among the pieces of the same length.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import partitions, slices, stored, text_or_empty
from tradewind.llm.encoding import REMEMBERED, encoder

# Lengths and how many of each, and the number of sequences filled so.
Pattern = tuple[dict[int, int], int]
FILLINGS = 50_000  # partial fillings of one room that the complete search looks at: bounds the driver's memory


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: sequences with equal contents are handled together."""
    open_bins: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in open_bins if r >= length), default=None)
            filled, n = open_bins[room].pop() if room is not None else ({}, left)
            if room is not None and not open_bins[room]:
                del open_bins[room]
            room = capacity if room is None else room
            fit = min(room // length, left)
            used = max(1, min(n, left // fit))
            if used < n and filled:
                open_bins.setdefault(room, []).append((filled, n - used))
            open_bins.setdefault(room - fit * length, []).append((filled | {length: fit}, used))
            left -= fit * used
    return [bin_ for bins in open_bins.values() for bin_ in bins]


def completions(available: np.ndarray, counts: dict[int, int], room: int, wanted: int) -> list[dict[int, int]]:
    """Good fillings of ``room`` with available lengths, found quickly: at most ``wanted``, the least waste first.

    A room of more than three pieces first gets the longest ones. What is then left is filled with one length, two, or
    three, and with whatever still fits.
    """
    found: list[tuple[int, int, dict[int, int]]] = []
    lengths = np.flatnonzero(available[: room + 1])
    if not len(lengths):
        return [{}]
    begun: dict[int, int] = {}
    for longest in lengths[::-1].tolist():
        if n := min(counts[longest], max(0, room // longest - 2)):
            begun[longest] = n
            room -= n * longest
        if room < 3 * longest:
            break
    lengths = lengths[lengths <= room]
    if not len(lengths):
        return [begun]
    fits = np.maximum.accumulate(np.where(available[: room + 1], np.arange(room + 1), 0))  # longest that fits each room

    def take(*chosen: int) -> dict[int, int] | None:
        some = dict(begun)
        for length in chosen:
            if length:
                some[length] = some.get(length, 0) + 1
        return some if all(counts[x] >= n for x, n in some.items()) else None

    def add(*chosen: int) -> None:
        if (some := take(*chosen)) is not None:
            left = room - sum(chosen)
            while (more := int(fits[left])) and counts[more] > some.get(more, 0):
                some = some | {more: some.get(more, 0) + 1}
                left -= more
            if all(some != x for _, _, x in found):
                found.append((left, sum(some.values()), some))

    add(int(lengths[-1]))
    if not found:  # the longest are all in use already
        add()
    second = fits[room - lengths]
    exact = lengths[(lengths + second == room) & (second > 0)]
    pairs = exact[::-1] if len(exact) else lengths[np.argsort(room - lengths - second, kind="stable")]
    for a in pairs[:wanted].tolist():
        add(a, int(fits[room - a]))
    if min(x[0] for x in found):
        for a in lengths[::-1][: 4 * wanted].tolist():
            rest = lengths[lengths <= room - a]
            third = fits[room - a - rest]
            waste = room - a - rest - third
            for i in np.argsort(waste, kind="stable")[:2].tolist():
                add(a, int(rest[i]), int(third[i]))
            if not min(x[0] for x in found):
                break
    found.sort(key=lambda x: x[:2])
    return [x for _, _, x in found[:wanted]]


def bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer sequences.

    For each limit up to half a sequence: lengths above half stand alone, those that leave less room than the limit take
    nothing from it on, and what is from the limit on up to half must fit beside the others or fill further sequences.
    """
    number = np.zeros(capacity + 1, np.int64)
    number[list(counts)] = list(counts.values())
    tokens = number * np.arange(capacity + 1)
    n, sums = np.cumsum(number), np.cumsum(tokens)
    half = capacity // 2
    large = int(n[capacity] - n[half])
    best = max(large, -(-int(sums[capacity]) // capacity))
    for limit in range(1, half + 1):
        if number[limit]:
            beside = int(n[capacity - limit] - n[half])  # large ones with room for the limit
            room = beside * capacity - int(sums[capacity - limit] - sums[half])
            best = max(best, large + max(0, -(-(int(sums[half] - sums[limit - 1]) - room) // capacity)))
    return best


def _above(bits: int, most: int) -> int:
    """The bits 1 to ``most`` places above each of ``bits``."""
    if not most:
        return 0
    out, span = bits << 1, 1
    while span < most:
        step = min(span, most - span)
        out, span = out | out << step, span + step
    return out


def undominated(counts: dict[int, int], room: int, waste: int, steps: int) -> tuple[list[tuple[int, dict[int, int]]], int]:
    """All undominated fillings of ``room`` that leave at most ``waste`` free, the least first, and the steps it took.

    A filling is dominated when some of its pieces, or none, can be exchanged for one that was left out and is longer
    than they are together, or as long as two or more of them. With more than ``steps`` partial fillings the list is not
    complete.
    """
    lengths = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    rest = np.cumsum([x * counts[x] for x in reversed(lengths)])[::-1].tolist() + [0]
    found: list[tuple[int, dict[int, int]]] = []
    todo, taken = [(0, room, ())], 0
    while todo and taken < steps:
        i, left, chosen = todo.pop()
        taken += 1
        if left - rest[i] > waste:
            continue
        if i < len(lengths):
            x = lengths[i]
            for n in range(min(counts[x], left // x) + 1):  # the most on top
                todo.append((i + 1, left - n * x, (*chosen, (x, n)) if n else chosen))
            continue
        one, more = 0, 0  # bit s: one piece, or several of them, are s long together
        for x, n in chosen:
            for _ in range(n):
                more |= (more | one) << x
                one |= 1 << x
        used = dict(chosen)
        out = 0
        for x in lengths:
            if counts[x] > used.get(x, 0):
                out |= 1 << x
        if not out & (_above(one | more | 1, left) | more):
            found.append((left, used))
    found.sort(key=lambda f: (f[0], sum(f[1].values())))
    return found, taken


@dataclass
class _Frame:
    """Where the complete search stands: what is to be packed, and the filling now tried, for so many sequences."""

    counts: dict[int, int]
    waste: int
    nogoods: list[dict[int, int]]
    ways: Iterator[tuple[int, dict[int, int], dict[int, int]]]
    tried: list[dict[int, int]] = field(default_factory=list)
    left: int = 0
    way: dict[int, int] = field(default_factory=dict)
    filled: dict[int, int] = field(default_factory=dict)
    copies: int = 0


@dataclass
class _Search:
    capacity: int
    least: int
    best: list[Pattern]
    nodes: int
    made: list[Pattern] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.best)

    def run(self, counts: dict[int, int], tokens: int, used: int) -> None:
        """Complete a sequence around the longest length left, in each way worth it, and go on with the rest."""
        stack = [(counts, tokens, used, 0, None)]
        while stack and self.nodes and self.sequences > self.least:
            counts, tokens, used, depth, pattern = stack.pop()
            del self.made[max(0, depth - 1) :]
            if pattern:
                self.made.append(pattern)
            # Waste so far and what must still be used: the branch can't win.
            if used + max(-(-tokens // self.capacity), 0) >= self.sequences:
                continue
            if not counts:
                self.best = list(self.made)
                continue
            self.nodes -= 1
            longest = max(counts)
            rest = dict(counts)
            rest[longest] -= 1
            available = np.zeros(self.capacity + 1, dtype=bool)
            available[[x for x, n in rest.items() if n]] = True
            ways = completions(available, rest, self.capacity - longest, 3)
            for way in reversed(ways):  # the best is on top
                filled = way | {longest: way.get(longest, 0) + 1}
                copies = min(counts[x] // n for x, n in filled.items())
                left = {x: n - copies * filled.get(x, 0) for x, n in counts.items() if n > copies * filled.get(x, 0)}
                size = copies * sum(x * n for x, n in filled.items())
                stack.append((left, tokens - size, used + copies, depth + 1, (filled, copies)))

    def complete(self, counts: dict[int, int], steps: int) -> bool:
        """Try every undominated filling around the longest length, for as many sequences as the counts allow, then for
        one less, and so on; whether all was tried.

        A filling that was tried in vain is a nogood for those after it, which are no fuller: a later sequence with all
        its pieces could exchange them for the other filling's, which gives a packing that was tried already. So with one
        copy less of a filling, no further sequence has it. How deep the search goes depends on the fillings that differ,
        not on the number of sequences.
        """
        tokens = sum(x * n for x, n in counts.items())
        frames: list[_Frame] = []
        made: list[Pattern] = []
        whole = True

        def spare() -> int:
            return (self.sequences - 1) * self.capacity - tokens

        def open_(counts: dict[int, int], waste: int, nogoods: list[dict[int, int]]) -> None:
            nonlocal steps, whole
            longest, most = max(counts), min(steps, FILLINGS)
            rest = {x: n - (x == longest) for x, n in counts.items()}
            found, taken = undominated(rest, self.capacity - longest, spare() - waste, most)
            steps -= taken + len(counts)
            whole = whole and taken < most
            every = ((left, way, way | {longest: way.get(longest, 0) + 1}) for left, way in found)
            ways = (w for w in every if not any(all(w[2].get(x, 0) >= n for x, n in bad.items()) for bad in nogoods))
            frames.append(_Frame(counts, waste, nogoods, ways))

        open_(counts, 0, [])
        while frames and steps > 0 and self.sequences > self.least:
            frame = frames[-1]
            if frame.copies > 1 and frame.way:
                frame.copies -= 1  # without that filling from there on
                made[-1] = (frame.filled, frame.copies)
                nogoods = [*frame.nogoods, *frame.tried, frame.way]
            else:
                if frame.copies:
                    made.pop()
                    frame.tried += [frame.way] * bool(frame.way)
                found = next(frame.ways, None)
                if found is None or frame.waste + found[0] > spare():
                    frames.pop()
                    continue
                frame.left, frame.way, frame.filled = found
                frame.copies = min(frame.counts[x] // n for x, n in frame.filled.items())
                if frame.left:
                    frame.copies = min(frame.copies, (spare() - frame.waste) // frame.left)
                made.append((frame.filled, frame.copies))
                nogoods = [*frame.nogoods, *frame.tried]
            used = {x: frame.copies * n for x, n in frame.filled.items()}
            rest = {x: n - used.get(x, 0) for x, n in frame.counts.items() if n > used.get(x, 0)}
            if not rest:
                self.best = list(made)
                continue
            open_(rest, frame.waste + frame.copies * frame.left, nogoods)
        return whole and not frames


def complete_bins(counts: dict[int, int], capacity: int, nodes: int = 6_000, steps: int = 1_000_000) -> list[Pattern]:
    """A packing of ``counts`` pieces of each length: patterns and the number of sequences each fills.

    Branch and bound around the longest length left, with best-fit decreasing as the first incumbent. It ends as soon as
    the lower bound is reached. First a quick search of at most ``nodes`` branches, which tries up to three good fillings
    at a time, each for as many sequences as the counts allow. A branch ends when the tokens left can't fit into fewer
    sequences than the best packing so far. Then all undominated fillings are tried, within the waste that a better
    packing may have, whatever the number of pieces; this ends after ``steps`` partial fillings. If it comes to its end,
    the packing is one of the fewest sequences.
    """
    counts = {x: n for x, n in counts.items() if n}
    search = _Search(capacity, bound(counts, capacity), best_fit(counts, capacity), nodes)
    search.run(counts, sum(x * n for x, n in counts.items()), 0)
    if search.sequences > search.least:
        search.complete(counts, steps)
    return search.best


def encode_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids: bool = False,
) -> DataFrame:
    """Documents as token ids with ``end_id`` behind, cut into pieces of at most ``capacity`` where they are longer.

    One row per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, and ``ids`` (little-endian unsigned
    32-bit) if asked for. A null text is empty: its document is the end id alone. Ids of documents may be null, and stay
    so, or repeat: each row is a document. An empty table gives an empty result.
    """
    fields = [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())
    ]
    schema = pa.schema(fields + [("ids", pa.binary())] * ids)
    end, step = struct.pack("<I", end_id), 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        own.remembered = REMEMBERED // 4
        for batch in slices(batches, "text", (2 if ids else 8) << 20):
            rows = []
            for doc, found in zip(batch.column("id").to_pylist(), own.encode(batch.column("text").to_pylist()), strict=True):
                whole = found + end
                for i in range(0, len(whole), step):
                    part = whole[i : i + step]
                    rows.append((doc, i // step, i // 4, len(part) // 4, zlib.crc32(part), part)[: len(schema)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
            )
            pa.default_memory_pool().release_unused()  # else Arrow keeps the room of a batch for good
        own.forget()  # tasks that follow need the room, and workers that wait for one must not hold it

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids
    return rows.mapInArrow(cut, kind)


def _slots(plan: list[Pattern]) -> tuple[np.ndarray, np.ndarray]:
    """For each length of each pattern: key (length and first rank), and first sequence, pieces a sequence, offset."""
    taken: dict[int, int] = {}
    keys, rows, sequence = [], [], 0
    for filled, copies in plan:
        offset = 0
        for length, n in sorted(filled.items(), reverse=True):
            keys.append((length << 40) + taken.get(length, 0))
            rows.append((taken.get(length, 0), sequence, n, offset))
            taken[length] = taken.get(length, 0) + n * copies
            offset += length * n
        sequence += copies
    order = np.argsort(keys, kind="stable") if keys else []
    return np.array(keys, dtype=np.int64)[order], np.array(rows, dtype=np.int64).reshape(-1, 4)[order]


def pack(pieces: DataFrame, capacity: int, nodes: int = 6_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: the place of each in sequences of at most ``capacity`` tokens.

    ``pieces`` must not change between reads (a stored table): it is read once to count the lengths and once to place.
    Of pieces of one length, it does not matter which goes where; they are ranked by document and piece. Rows that
    repeat get places of their own. An empty table gives an empty result.
    """
    # At most one row per length of a sequence, however many pieces there are.
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    keys, rows = _slots(complete_bins(counts, capacity, nodes))

    # Ranks in two steps, so that no task gets all pieces of one length.
    cell = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(4 * partitions(pieces)))
    dealt = pieces.withColumn("cell", cell)
    sizes = dealt.groupBy("length", "cell").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rank = F.row_number().over(W.partitionBy("length", "cell").orderBy("doc_id", "piece")) - 1
    ranked = dealt.withColumn("rank", rank).join(sizes, ["length", "cell"]).drop("cell")
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("first")).drop("first")

    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def assign(length: pa.Array, rank: pa.Array) -> pa.Array:
        long, nth = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False).astype(np.int64)
        slot = rows[np.searchsorted(keys, (long << 40) + nth, side="right") - 1]
        nth, n = nth - slot[:, 0], slot[:, 2]
        columns = [slot[:, 1] + nth // n, slot[:, 3] + nth % n * long]
        return pa.StructArray.from_arrays(list(map(pa.array, columns)), names=["sequence_id", "offset"])

    placed = ranked.withColumn("slot", assign("length", "rank"))
    return placed.select(*pieces.columns, "slot.sequence_id", "slot.offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, ids: bool = False, **columns) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` tokens: see ``encode_pieces`` and ``pack``."""
    pieces = stored(encode_pieces(docs, tokenizer, capacity, ids=ids, **columns), "pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, one array per row, from ``pack_documents(..., ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most a sequence's tokens
    whole = packed.groupBy("sequence_id").agg(F.array_join(F.transform(parts, lambda p: F.hex(p["ids"])), "").alias("hex"))
    return whole.select("sequence_id", F.unhex("hex").alias("ids"))

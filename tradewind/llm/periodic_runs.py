"""Periodic runs of words by maximal pairs in the tree of LCP intervals.

A pair of places is maximal when the words from both agree for a number of words, and neither the words before them nor
those behind agree. If the two places lie no further apart than that number, the stretch from the first place to the
second end repeats with that distance, and because the pair is maximal nothing extends it: such pairs are exactly the
runs, and a run's smallest period is the least distance of those with the same stretch.

Suffixes are sorted by doubling, only as long as their words so far occur more than once in their document. Bottom-up
over the intervals of their common prefixes, the places below a node are kept in order, together with those places where
the word to the left changes. Two children are merged place by place from the smaller one: within the reach of the
prefix, whole stretches with the same left word are stepped over, so that work is done for maximal pairs alone. Groups of
suffixes that all have the same left word, or lie too far apart, are left out beforehand.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradewind.llm.common import slices, text_or_empty

# Start, distance, and common words of a pair.
Pair = tuple[int, int, int]


def repeated_suffixes(labels: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and how many labels each has in common with the one before.

    Only places that have at least ``least`` labels in common with another one; the number is 0 where it is less.
    """
    n = len(labels)
    active, second = np.arange(n), np.unique(labels, return_inverse=True)[1].astype(np.int64)
    rank, key, size = np.zeros(n, np.int64), second, 1
    levels: list[tuple[int, np.ndarray, np.ndarray]] = []
    while True:
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(np.r_[new, len(key)])
        # A group's rank is the place of its first suffix among all: ranks of the prefix before, and behind it in its group.
        old = rank[active]
        begins = np.flatnonzero(np.r_[True, old[1:] != old[:-1]]) if len(old) else new
        within = np.repeat(new, counts) - np.repeat(begins, np.diff(np.r_[begins, len(old)]))
        rank[active] = old + within
        active = active[np.repeat(counts > 1, counts)]
        if not len(active):
            break
        levels.append((size, active, rank[active]))
        behind = active + size
        key = rank[active] * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)] + 1, 0)
        size *= 2
    candidates = next((a for s, a, _ in reversed(levels) if s <= least), active)
    places = candidates[np.argsort(rank[candidates])]
    before, common = places[:-1], np.zeros(max(0, len(places) - 1), np.int64)
    after = places[1:]
    for size, some, named in reversed(levels):
        of = np.full(n + 1, -1, np.int64)
        of[some] = named
        a, b = of[np.minimum(before + common, n)], of[np.minimum(after + common, n)]
        common += size * ((a == b) & (a >= 0))
    common = np.r_[0, common][: len(places)]
    common[common < least] = 0
    alone = (common == 0) & np.r_[common[1:] == 0, True][: len(common)]
    return places[~alone], common[~alone]


class _Below:
    """The places below a node, in order, and those of them whose left word differs from that of the place before."""

    __slots__ = ("places", "turns")

    def __init__(self, place: int):
        self.places, self.turns = [place], [place]

    def pairs(self, x: int, common: int, left: list[int], found: list[Pair]) -> None:
        """Pairs of ``x`` and a place here, with another left word and at most ``common`` apart."""
        places, turns = self.places, self.turns
        at, end = bisect_left(places, x - common), bisect_right(places, x + common)
        while at < end:
            turn = bisect_right(turns, places[at])
            stop = min(end, bisect_left(places, turns[turn])) if turn < len(turns) else end
            if left[places[at]] != left[x]:
                found += [(min(x, y), abs(x - y), common) for y in places[at:stop]]
            at = stop

    def put(self, x: int, left: list[int]) -> None:
        places, turns = self.places, self.turns
        at = bisect_left(places, x)
        if at < len(places):
            after = places[at]
            was, turns_now = at == 0 or left[places[at - 1]] != left[after], left[x] != left[after]
            if was and not turns_now:
                del turns[bisect_left(turns, after)]
            elif turns_now and not was:
                insort(turns, after)
        if at == 0 or left[places[at - 1]] != left[x]:
            insort(turns, x)
        places.insert(at, x)


def _merged(one: _Below, two: _Below, common: int, left: list[int], found: list[Pair]) -> _Below:
    if len(one.places) < len(two.places):
        one, two = two, one
    for x in two.places:
        one.pairs(x, common, left, found)
    for x in two.places:
        one.put(x, left)
    return one


def maximal_pairs(places: list[int], common: list[int], left: list[int]) -> list[Pair]:
    """All maximal pairs of suffixes in order whose places are no further apart than they have labels in common."""
    found: list[Pair] = []
    open_: list[tuple[int, _Below]] = []
    for place, following in zip(places, [*common, 0][1:], strict=True):
        node = _Below(place)
        while open_ and open_[-1][0] >= following:
            size, below = open_.pop()
            node = _merged(below, node, size, left, found)
            if size == following:
                break
        if following:
            open_.append((following, node))
    return found


def runs_of(labels: np.ndarray, least: int) -> np.ndarray:
    """The runs of at least ``least`` labels: rows of start, length and smallest period, by start and period.

    A run is at least twice as long as its period.
    """
    shared = -(-least // 2)
    places, common = repeated_suffixes(labels, shared)
    if not len(places):
        return np.zeros((0, 3), np.int64)
    left = np.r_[-1, labels[:-1]]
    begins = np.flatnonzero(common == 0)
    group = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(places)]))
    order = np.lexsort((places, group))
    gap = np.diff(places[order], prepend=-1)
    gap[begins] = np.iinfo(np.int64).max
    near = np.minimum.reduceat(gap, begins) <= np.maximum.reduceat(common, begins)
    own = left[places]
    several = np.minimum.reduceat(own, begins) != np.maximum.reduceat(own, begins)
    wanted = (near & several)[group]
    if not wanted.any():
        return np.zeros((0, 3), np.int64)
    pairs = np.array(maximal_pairs(places[wanted].tolist(), common[wanted].tolist(), left.tolist()), np.int64).reshape(-1, 3)
    found = np.stack([pairs[:, 0], pairs[:, 1] + pairs[:, 2], pairs[:, 1]], axis=1)
    found = found[found[:, 1] >= least]
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)][: len(found)]
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def _labels(words: list[list[bytes]], sizes: np.ndarray) -> np.ndarray:
    """A number for each word, by document: equal only for equal words of the same one."""
    every = pa.array([w for some in words for w in some], pa.binary()).dictionary_encode()
    numbers = every.indices.to_numpy().astype(np.int64)
    return np.repeat(np.arange(len(sizes)), sizes) * (1 + len(every.dictionary)) + numbers


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, least: int = 12, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, its ``runs`` and its text ``collapsed``.

    Words are what stands between ASCII white space, numbered from 0; they agree when identical. A run is a stretch of at
    least ``least`` words and twice its smallest period that no neighbouring word extends with that period. ``runs`` has
    start, length and period, by start and period. ``collapsed`` are the words in no run but its first period's, joined
    by a space. A null text is empty and, like a text without words, has no runs and an empty collapsed text. Ids may be
    null or repeat, each row stands for itself; an empty table gives an empty result, and other columns are not looked
    at. Texts are searched whole, however long.
    """
    if least < 2:
        raise ValueError("a run has two words at least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            words = [t.encode().split() for t in batch.column("text").to_pylist()]
            sizes = np.array([len(w) for w in words], np.int64)
            ends = np.cumsum(sizes)
            begins = ends - sizes
            found = runs_of(_labels(words, sizes), least)
            owner = np.searchsorted(ends, found[:, 0], side="right")
            # Words behind a run's first period go: up where they begin, down where they end.
            steps = np.bincount(found[:, 0] + found[:, 2], minlength=int(sizes.sum()) + 1)
            steps -= np.bincount(found[:, 0] + found[:, 1], minlength=len(steps))
            gone = np.cumsum(steps) > 0
            collapsed = [b" ".join(w) for w in words]
            for i in np.unique(owner).tolist():
                keep = ~gone[begins[i] : ends[i]]
                collapsed[i] = b" ".join([w for w, k in zip(words[i], keep.tolist(), strict=True) if k])
            found[:, 0] -= begins[owner]
            offsets = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(words)))]
            entries = pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(3)], fields=list(_RUN))
            columns = [
                batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries),
                pa.array([c.decode() for c in collapsed], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(run, kind)

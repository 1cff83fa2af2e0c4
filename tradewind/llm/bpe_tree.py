"""Byte-level BPE encoding and decoding as a reduction over a tree of spans.

The encoded spans of a text form a monoid: two neighbours are joined without encoding either of them again. A text is
halved until a span has at most ``LEAF`` characters; a leaf is split by the pattern and each word of it encoded. A join
works at the seam alone, on two levels:

Words. A match of the pattern depends on nothing before its start and on no more than the two characters behind it
(``LOOK``), so those of the left span that end before the seam, and start far enough from it, stay. From the last of them
the text is matched again over a growing window until a match ends where the right span has a boundary; from there on
the right span's words stay as well.

Tokens of one word. Merges are made lowest rank first, the leftmost of equal ones first. Tokens side by side are the
encoding of their bytes exactly when each two neighbours, encoded together, come out as they are: the first merge across
a seam would have been made with the two tokens at that seam alone too. So the tokens next to the seam are encoded again
as a window, which grows on each side where its outermost token does not stand beside the next one. Long words are
encoded so, by halves of their bytes.

Decoding joins the bytes of halves.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tradewind.llm.common import slices, text_or_empty

LEAF = 2048
LOOK = 3  # characters from a match's start that its choice among the pattern's alternatives may rest on
_DIRECT = 32  # bytes of a word that are merged without halving
_LONG = 256  # characters of a word that is not remembered
REMEMBERED = 400_000  # words, twice, and pairs of tokens that one worker remembers; about 200 bytes each
_STEP = 1 << 32

# A span's words, and the ids of each as little-endian unsigned 32-bit bytes.
Span = tuple[list[str], list[bytes]]


class _Words(dict):
    """Ids by word; a word that is neither here nor among the ``older`` ones is encoded."""

    def __init__(self, encode, older: dict[str, bytes]):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, word: str) -> bytes:
        if (ids := self.older.get(word)) is None:
            ids = self.encode(word)
        if len(word) < _LONG:
            self[word] = ids
        return ids


class TreeBpe:
    """The tokens of a rank table. ``pattern`` must look no further than ``LOOK`` characters, as the public ones do.

    Each token must be what its own bytes merge into; else ValueError.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF):
        self.ranks, self.find, self.leaf = ranks, regex.compile(pattern).findall, max(1, leaf)
        self.bytes_of = dict(zip(ranks.values(), ranks, strict=True))
        self.words = _Words(lambda word: self._packed(self.tokens(word.encode())), {})
        self.pairs: dict[int, list[int]] = {}
        for raw, rank in ranks.items():
            if self.merged(raw) != [rank]:
                raise ValueError(f"token {rank} is not what its bytes merge into")

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    # Tokens of one word

    def merged(self, raw: bytes) -> list[int]:
        """The tokens of a few bytes: one merge after another, the lowest rank first."""
        if len(raw) > 64:
            return self._merged_by_heap(raw)
        ranks = self.ranks
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [ranks.get(a + b, _STEP) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) < _STEP:
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _STEP)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], _STEP)
        return [ranks[p] for p in parts]

    def _merged_by_heap(self, raw: bytes) -> list[int]:
        n, ranks = len(raw), self.ranks
        end = list(range(1, n + 1))  # of the part that starts here; 0 where none does
        back = list(range(-1, n))
        todo = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(todo)
        while todo:
            _, i, stop = heapq.heappop(todo)
            middle = end[i]
            if not middle or middle >= n or end[middle] != stop:
                continue  # one of the two is another part by now
            end[i], end[middle], back[stop] = stop, 0, i
            for a, b in ((back[i], stop), (i, end[stop] if stop < n else 0)):
                if a >= 0 and b and (rank := ranks.get(raw[a:b])) is not None:
                    heapq.heappush(todo, (rank, a, b))
        return [ranks[raw[i : end[i]]] for i in range(n) if end[i]]

    def pair(self, a: int, b: int) -> list[int]:
        """The encoding of the bytes of two tokens."""
        key = a * _STEP + b
        if (found := self.pairs.get(key)) is None:
            found = self.pairs[key] = self.merged(self.bytes_of[a] + self.bytes_of[b])
        return found

    def join_tokens(self, a: list[int], b: list[int]) -> list[int]:
        """The tokens of the bytes of ``a`` and ``b``, each the encoding of its own."""
        if not a or not b:
            return a or b
        i = j = 1
        window = self.pair(a[-1], b[0])
        while True:
            left = i == len(a) or self.pair(a[-i - 1], window[0]) == [a[-i - 1], window[0]]
            right = j == len(b) or self.pair(window[-1], b[j]) == [window[-1], b[j]]
            if left and right:
                return a[:-i] + window + b[j:]
            i = i if left else min(2 * i, len(a))
            j = j if right else min(2 * j, len(b))
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, a[-i:] + b[:j])))

    def tokens(self, raw: bytes) -> list[int]:
        """The tokens of one word."""
        if (whole := self.ranks.get(raw)) is not None:
            return [whole]
        if len(raw) <= _DIRECT:
            return self.merged(raw)
        half = len(raw) // 2
        return self.join_tokens(self.tokens(raw[:half]), self.tokens(raw[half:]))

    # Spans of a text

    def join(self, left: Span, right: Span) -> Span:
        """The words and ids of the text of ``left`` and ``right``."""
        words, others = left[0], right[0]
        if not words or not others:
            return left if words else right
        kept, tail = len(words), 0  # words of the left span that stay, characters behind them
        while kept and (tail < 1 or tail + len(words[kept - 1]) < LOOK):
            kept -= 1
            tail += len(words[kept])
        before = "".join(words[kept:])
        taken = 1
        while True:
            taken = min(taken, len(others))
            window = before + "".join(others[:taken])
            found, n = self.find(window), 0
            if taken == len(others):
                stop = n = len(found)
                break
            starts, at = {}, len(before)
            for k in range(taken):
                starts[at] = k
                at += len(others[k])
            stop, at = None, 0
            for n, word in enumerate(found, 1):
                if at + LOOK > len(window) or at + len(word) >= len(window):
                    break
                at += len(word)
                if at in starts:
                    stop = n
                    break
            if stop is not None:
                taken, found = starts[at], found[:stop]
                break
            taken *= 2
        ids = self._seam(found, (words[kept:], left[1][kept:]), (others[:taken], right[1][:taken]))
        return words[:kept] + found + others[taken:], left[1][:kept] + ids + right[1][taken:]

    def _seam(self, found: list[str], left: Span, right: Span) -> list[bytes]:
        """The ids of the words around a seam. Of a long word made of whole words of both sides, the tokens are joined."""
        if all(len(w) < _LONG for w in found):
            return list(map(self.words.__getitem__, found))
        ends, at = {0: 0}, 0
        for k, word in enumerate(left[0] + right[0], 1):
            at += len(word)
            ends[at] = k
        every, out, at = left[1] + right[1], [], 0
        for word in found:
            first, last = ends.get(at), ends.get(at + len(word))
            at += len(word)
            if len(word) < _LONG or first is None or last is None:
                out.append(self.words[word])
                continue
            ids: list[int] = []
            for part in every[first:last]:
                ids = self.join_tokens(ids, np.frombuffer(part, "<u4").tolist())
            out.append(self._packed(ids))
        return out

    def _span(self, text: str, low: int, high: int) -> Span:
        if high - low <= self.leaf:
            words = self.find(text[low:high])
            return words, list(map(self.words.__getitem__, words))
        middle = (low + high) // 2
        return self.join(self._span(text, low, middle), self._span(text, middle, high))

    def _forget(self) -> None:
        """Bound what is remembered: of words those met lately stay."""
        if len(self.words) > REMEMBERED:
            self.words = _Words(self.words.encode, self.words)
            self.words.older.older = {}
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()

    def encode(self, text: str) -> bytes:
        """The ids of ``text``, as little-endian unsigned 32-bit bytes."""
        self._forget()
        return b"".join(self._span(text, 0, len(text))[1])

    def decode(self, ids: bytes) -> bytes:
        """The bytes that ``ids`` stand for."""
        if len(ids) <= 4 * self.leaf:
            return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        half = len(ids) // 8 * 4
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=2)
def tree_bpe(path: str, pattern: str) -> TreeBpe:
    """The tokenizer of a file of ranks: a token in base 64 and its rank in each line. One per Python worker and file."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    return TreeBpe({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)


def encode(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_tokens``, ``ids`` and, if asked for, ``decoded``.

    ``ranks`` is the path of a file of ranks and ``pattern`` splits text into words. ``ids`` are little-endian unsigned
    32-bit, ``decoded`` are the bytes they stand for: those of the text. Strings of special tokens are ordinary text. A
    null text is empty and has no ids. Ids of documents may be null or repeat, each row stands for itself; an empty
    table gives an empty result, and other columns are not looked at. Texts are encoded whole, however long.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    schema = pa.schema(fields + [("decoded", pa.binary())] * decode)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_bpe(ranks, pattern)
        for batch in slices(batches, "text", 4 << 20):
            ids = [own.encode(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array(map(own.decode, ids), pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary" + ", decoded binary" * decode)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes that the ids of each row stand for; null where the ids are null.

    A column named ``decoded`` is replaced. Ids that the ranks don't have raise.
    """
    kept = encoded.select(*[c for c in encoded.columns if c.lower() != "decoded"])
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tree_bpe(ranks, pattern)
        for batch in batches:
            found = [None if x is None else own.decode(x) for x in batch.column(ids_col).to_pylist()]
            yield batch.append_column("decoded", pa.array(found, pa.binary()))

    return kept.mapInArrow(run, kind)

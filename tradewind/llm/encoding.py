"""Encoding of texts with the tokenizers library inside Spark tasks.

Where a tokenizer never joins what stands on the two sides of a lone space, a text is cut there, and each distinct part
is encoded once and remembered: natural texts repeat their words. Arrow cuts the texts of a batch, finds the distinct
parts and puts their ids in place, so Python handles each of them once a batch. A new part in Latin letters is split by the
tokenizer's own pattern, and the library's model encodes each distinct word of it once; any other part goes through the
library as it is. So does a whole text with two white-space characters in a row, and every text of a tokenizer that
allows no cuts. Either way the ids are those of the whole text.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

# Parts remembered by one Python worker, twice: when full, those not met since the last time are forgotten. About 200
# bytes each.
REMEMBERED = 500_000
# Two white-space characters in a row, by the code points that Python and the tokenizers' patterns take as such. Arrow's
# own class has ASCII only.
_SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ADJACENT = f"[{_SPACES}][{_SPACES}]"
# Fixed value: how byte-level tokenizers split text when their file names no pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Below it, letters are the same in every Unicode version, and composed: NFC leaves them.
_LATIN_END = "\u0250"
_MARKS = ",.;:!?"


def _byte_letters() -> dict[int, int]:
    """Bytes as printable characters, as byte-level tokenizers write them: the others move up to 256 and beyond."""
    plain = [b for b in range(256) if 33 <= b <= 126 or (161 <= b <= 255 and b != 173)]
    moved = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(moved)}


def _cut(spec: dict) -> str:
    """How a text may be cut at lone spaces: ``keep`` the space before a part, ``drop`` it, or ``none``."""
    before = spec.get("pre_tokenizer") or {}
    steps = before.get("pretokenizers", [before])
    last = steps[-1]
    if last.get("type") != "ByteLevel" or last.get("add_prefix_space") or spec.get("post_processor"):
        return "none"
    if len(steps) == 1 and last.get("use_regex") and not spec.get("normalizer"):
        return "keep"
    first = steps[0]
    drops = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    normalizers = {n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])}
    if len(steps) == 2 and drops and not last.get("use_regex") and normalizers <= {"NFC", "Replace", "Lowercase"}:
        return "drop"
    return "none"


class _Parts(dict):
    """Ids by part. One that is neither here nor among the ``older`` ones is found."""

    def __init__(self, find: Callable[[str], bytes], older: dict[str, bytes] | None = None):
        super().__init__()
        self.find, self.older = find, older or {}

    def __missing__(self, part: str) -> bytes:
        if (ids := self.older.get(part)) is None:
            ids = self.find(part)
        self[part] = ids
        return ids

    def next(self) -> _Parts:
        """An empty one, with these as the older ones."""
        self.older = {}
        return _Parts(self.find, self)


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit bytes. Strings of special tokens in a text are ordinary text."""

    def __init__(self, tokenizer: Tokenizer, cut: str, pattern: str = BYTE_LEVEL):
        self.tokenizer, self.cut = tokenizer, cut
        self.tokenizer.encode_special_tokens = True
        self.split, self.letters, self.model = regex.compile(pattern).findall, _byte_letters(), tokenizer.model
        self.lead = " " if cut == "keep" else ""
        self.remembered = REMEMBERED
        self.forget()

    def forget(self) -> None:
        """Free what is remembered: parts behind a space, parts at the start of a text, and words of the pattern."""
        self.parts = _Parts(lambda part: self._part(part, self.lead))
        self.starts = _Parts(lambda part: self._part(part, ""))
        self.words = _Parts(self._word)

    def _bound(self) -> None:
        """Of what is remembered, keep those met lately: two generations."""
        for name in ("parts", "starts", "words"):
            if len(known := getattr(self, name)) > self.remembered:
                setattr(self, name, known.next())

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [struct.pack(f"<{len(x.ids)}I", *x.ids) for x in found]

    def _word(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _part(self, part: str, lead: str) -> bytes:
        """The ids of a part. Letters, and letters with a mark behind, need no pattern to be split."""
        if not part or not part.isascii() and max(part) >= _LATIN_END:
            # Alone, as the library's threads cost more than one part.
            ids = self.tokenizer.encode(lead + part, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        if self.cut == "drop":
            part = part.lower()
        if part.isalpha():
            return self._word(lead + part)
        if part[-1] in _MARKS and part[:-1].isalpha():
            known = self.parts if lead == self.lead else self.starts
            return known[part[:-1]] + self.words[part[-1]]
        return b"".join(map(self.words.__getitem__, self.split(lead + part)))

    def _whole(self, text: str) -> bool:
        """Whether a text must not be cut, but for white space in a row."""
        return self.cut == "none"

    def _prepare(self, texts: list[str]) -> None:
        """Called with all texts that will be cut."""

    def _joined(self, texts: pa.Array) -> list[bytes]:
        """The ids of each of some texts, which may all be cut."""
        cut = pc.split_pattern(texts, " ")
        bounds, parts = cut.offsets.to_numpy(), cut.values.dictionary_encode()
        ids = list(map(self.parts.__getitem__, parts.dictionary.to_numpy(zero_copy_only=False)))
        firsts = cut.values.take(cut.offsets[:-1]).to_pylist()
        place = parts.indices.to_numpy().copy()
        place[bounds[:-1]] = np.arange(len(ids), len(ids) + len(firsts))
        ids += map(self.starts.__getitem__, firsts)
        _, ends, every = pa.array(ids, pa.large_binary()).take(pa.array(place)).buffers()
        ends, every = np.frombuffer(ends, np.int64)[bounds].tolist(), memoryview(every or b"")
        return [bytes(every[a:b]) for a, b in pairwise(ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        self._bound()
        column = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(column, _ADJACENT).to_pylist()
        whole = [i for i, t in enumerate(texts) if odd[i] or self._whole(t)]
        found = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True)) if whole else {}
        rest = [i for i in range(len(texts)) if i not in found]
        if rest:
            self._prepare([texts[i] for i in rest])
            found |= zip(rest, self._joined(column.take(pa.array(rest)) if whole else column), strict=True)
        return [found[i] for i in range(len(texts))]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file. One per Python worker and file."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cut = _cut(spec)
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if cut == "drop" else BYTE_LEVEL
    return Encoder(Tokenizer.from_file(path), cut, pattern)

"""SentencePiece encoding and decoding with the tokenizers library, rebuilt from the model file.

The model's protobuf gives pieces, scores and settings. From them come the normaliser (character map, surplus spaces,
dummy prefix, metaspace marker), the model (unigram scores, or for a BPE model the merges that its scores imply, both
with byte fallback) and the decoder. Nothing of the sentencepiece library runs here; tests hold the ids against it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from tradewind.llm.common import slices, text_or_empty
from tradewind.llm.encoding import Encoder

META = "▁"
# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What a SentencePiece model file holds."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    drop_extra_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def read(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own.get(2, b"\0\0\0\0"))[0]
                model.pieces.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                own = dict(_fields(value))
                model.kind, model.byte_fallback = own.get(3, UNIGRAM), bool(own.get(35, 0))
                if own.get(24):
                    raise ValueError("models with the space marker behind the word aren't supported")
            elif number == 3:
                own = dict(_fields(value))
                model.charsmap = own.get(2, b"")
                model.dummy_prefix, model.drop_extra_spaces = bool(own.get(3, 1)), bool(own.get(4, 1))
                model.escape_spaces = bool(own.get(5, 1))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        return model

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """Every way to put a piece together from two, the best-scored piece first."""
        ids = {piece: i for i, (piece, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        ways = [
            (-score, ids[a], ids[b], a, b)
            for piece, score, kind in self.pieces
            if kind in (NORMAL, USER_DEFINED)
            for a, b in ((piece[:i], piece[i:]) for i in range(1, len(piece)))
            if a in ids and b in ids
        ]
        return [(a, b) for *_, a, b in sorted(ways)]

    def tokenizer(self) -> Tokenizer:
        if self.kind == UNIGRAM:
            own = Tokenizer(models.Unigram([p[:2] for p in self.pieces], self.unknown, self.byte_fallback))
        else:
            vocabulary = {piece: i for i, (piece, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown][0]
            own = Tokenizer(
                models.BPE(vocabulary, self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
            )
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.drop_extra_spaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(META if self.escape_spaces else " "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", META))
        own.normalizer = normalizers.Sequence(steps)
        back = [decoders.Replace(META, " "), decoders.ByteFallback(), decoders.Fuse()]
        own.decoder = decoders.Sequence(back + [decoders.Strip(" ", 1, 0)] * self.dummy_prefix)
        return own

    @property
    def cuts_at_spaces(self) -> bool:
        """Whether no piece reaches over a lone space, so that the parts between them encode alone."""
        plain = self.dummy_prefix and self.escape_spaces and not self.charsmap and not self.drop_extra_spaces
        return plain and all(META not in p[1:] or not p.strip(META) for p, *_ in self.pieces)


class PieceCodec(Encoder):
    """Encodes batches with a piece model; see ``Encoder`` for what is remembered.

    The library puts the space marker before a part that stands alone, as it does before one behind a space.
    """

    def __init__(self, model: PieceModel):
        super().__init__(model.tokenizer(), "piece" if model.cuts_at_spaces else "none")

    def _prepare(self, texts: list[str]) -> None:
        """All parts that are met for the first time go through the library in one call, which shares them among threads."""
        new = set().union(*(t.split(" ") for t in texts)).difference(self.parts, self.parts.older)
        some = list(new)
        self.parts.update(zip(some, self._library(some), strict=True))
        self.starts = self.parts  # a text's first part is like any other

    def _whole(self, text: str) -> bool:
        return super()._whole(text) or text[:1] == " " or text[-1:] == " " or META in text

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.tokenizer.decode_batch([np.frombuffer(x, "<u4").tolist() for x in ids], skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    with open(path, "rb") as file:
        return PieceCodec(PieceModel.read(file.read()))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_ids``, ``ids_crc32``, ``ids`` and, if asked for, ``decoded``.

    Ids are those of the whole text without sentence marks. A null text is empty and has no ids; ids of documents may be
    null or repeat. Decoding gives the text back but for what the model normalises, and unknown characters of a model
    without byte fallback. An empty table gives an empty result, and other columns are not looked at.
    """
    kinds = [("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.uint32()))]
    schema = pa.schema(kinds + [("decoded", pa.string())] * decode)
    schema = schema.set(3, pa.field("ids", pa.list_(pa.int64())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in slices(batches, "text"):
            ids = own.encode(batch.column("text").to_pylist())
            sizes = [len(x) // 4 for x in ids]
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(flat))
            columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(map(zlib.crc32, ids), pa.int64()), lists]
            if decode:
                columns.append(pa.array(own.decode(ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = docs.select(docs[id_col].cast("long").alias("id"), text_or_empty(docs[text_col]).alias("text"))
    kind = "doc_id long, n_ids long, ids_crc32 long, ids array<long>" + ", decoded string" * decode
    return rows.mapInArrow(run, kind)

"""Byte-level BPE by tree reduction against the tiktoken library."""

from __future__ import annotations

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import tiktoken
from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from tradewind.llm import bpe_tree
from tradewind.llm.queries import BYTE_RANKS, op11_byte_bpe

SF = "/root/testdata/sf0.001"
RANKS = tokenizer_path(BYTE_RANKS)


@pytest.fixture(scope="module")
def own():
    return bpe_tree.tree_bpe(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(own):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


@pytest.fixture(scope="module")
def small(own):
    """The same with spans of three characters, so that everything is joined."""
    found = bpe_tree.TreeBpe({bytes([i]): i for i in range(256)}, PATTERN, leaf=3)
    found.ranks, found.bytes_of = own.ranks, own.bytes_of
    return found


def ids_of(x):
    return np.frombuffer(x, "<u4").tolist()


ALPHABETS = ["ab '", "'re ve s ll", "  \n\t x1.", "abcdefgh ", "日本語 é１2", "aA1 .,\n", " 　\x85\x1c'sl", "🙂👍a "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_random_texts(own, small, library, alphabet):
    draw = random.Random(alphabet)
    for _ in range(400):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 70)))
        for some in (own, small):
            assert ids_of(some.encode(text)) == library.encode_ordinary(text)
            assert some.decode(some.encode(text)) == text.encode()


def test_long_words_and_texts(own, library):
    draw = random.Random(1)
    texts = ["a" * 9000, "ab" * 4000, " " * 3000 + "x", "aaaa" * 999 + "b", "é" * 5000, "." * 3000, "\n" * 3000 + " " * 2500 + "a"]
    texts += ["".join(draw.choice(letters) for _ in range(9000)) for letters in ("abcd", "etaoinshr", "ab ")]
    for text in texts:
        assert ids_of(own.encode(text)) == library.encode_ordinary(text)
        assert own.decode(own.encode(text)) == text.encode()


def test_joined_tokens_are_those_of_all_bytes(own):
    draw = random.Random(2)
    for _ in range(500):
        raw = bytes(draw.choice(b"thereinstoa") for _ in range(draw.randint(2, 90)))
        at = draw.randint(0, len(raw))
        assert own.join_tokens(own.merged(raw[:at]), own.merged(raw[at:])) == own.merged(raw)


def test_both_ways_of_merging_agree(own):
    draw = random.Random(3)
    for _ in range(300):
        raw = bytes(draw.choice(b"aabcd") for _ in range(draw.randint(1, 60)))
        assert own._merged_by_heap(raw) == own.merged(raw)


def test_what_is_forgotten_does_not_matter(own, library, monkeypatch):
    monkeypatch.setattr(bpe_tree, "REMEMBERED", 5)
    for _ in range(3):
        for text in ("one two three four five six seven", "two 8 nine ten one"):
            assert ids_of(own.encode(text)) == library.encode_ordinary(text)


def test_ranks_that_do_not_make_their_tokens_are_refused():
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 256}
    with pytest.raises(ValueError, match="256"):
        bpe_tree.TreeBpe(ranks, PATTERN)


def test_awkward_rows(documents, nothing, texts, library):
    found = bpe_tree.encode(documents, RANKS, PATTERN)
    rows = found.collect()
    want = Counter((r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect())
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in rows) == want
    for r in rows:
        assert ids_of(r.ids) == library.encode_ordinary(bytes(r.decoded).decode()) and r.n_tokens == len(r.ids) // 4
    assert bpe_tree.encode(nothing, RANKS, PATTERN).collect() == []
    bare = bpe_tree.encode(documents, RANKS, PATTERN, decode=False)
    assert bare.columns == ["doc_id", "n_tokens", "ids"]
    nulls = bare.withColumns({"ids": F.when(F.col("doc_id") != 7, F.col("ids")), "Decoded": F.lit(1)})
    again = bpe_tree.decode(nulls, RANKS, PATTERN).collect()
    assert {r.doc_id: None if r.decoded is None else bytes(r.decoded).decode() for r in again if r.doc_id is not None} == {
        i: None if i == 7 else t or "" for i, t in texts.items()
    }


def test_query_over_its_whole_table(spark, library):
    found = {r.doc_id: tuple(r)[1:] for r in op11_byte_bpe(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        digests = (np.array(ids, "<u4").tobytes(), (r.text or "").encode())
        assert found[r.doc_id] == (len(ids), *(hashlib.sha256(x).hexdigest() for x in digests))


def test_the_rank_file_is_read_as_it_is(own):
    with open(RANKS, "rb") as file:
        lines = [line.split() for line in file]
    assert own.ranks == {base64.b64decode(a): int(b) for a, b in lines}

"""Each operator on a small table with every awkward case, against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_methods import plain_features
from tradewind.llm import sentencepiece_codec
from tradewind.llm.common import components
from tradewind.llm.embedding_dedup import embedding_groups
from tradewind.llm.exact_dedup import exact_dedup
from tradewind.llm.length_histogram import length_histogram, quantile, truncated_total
from tradewind.llm.packing import pack_documents, sequences
from tradewind.llm.quality import fit, quality
from tradewind.llm.sharding import TOKEN, shard
from tradewind.llm.simhash import simhash_groups
from tradewind.llm.substring_dedup import cut_passages, repeated_passages
from tradewind.llm.token_blocks import read_tokens, write_tokens
from tradewind.sources.scratch import scratch_path

BYTES, WORDS = (tokenizer_path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
PIECES = tokenizer_path("piece_bpe_32k.model")


def rows_of(documents):
    return [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").collect()]


def ids_of(path, text):
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own.encode(text, add_special_tokens=False).ids


def checksum(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def least_reachable(n, pairs, names):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    members = defaultdict(list)
    for i in range(n):
        members[find(i)].append(names[i])
    least = {r: min((x for x in some if x is not None), default=None) for r, some in members.items()}
    return [least[find(i)] for i in range(n)]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 30), (30, 3), (50, 51), (51, 50), (60, 60), (None, 1)]
    links += [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in components(df, "a", "b", "node", "root").collect()}
    assert found[30] == found[9] == 1 and found[51] == 50 and 60 not in found
    assert {found[i] for i in range(100, 140)} == {100} and {found[i] for i in range(200, 231)} == {200}
    assert components(df.limit(0), "a", "b", "node", "root").count() == 0


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup(documents, nothing, keep):
    groups = defaultdict(list)
    for i, t in rows_of(documents):
        groups[t].append(i)
    found = exact_dedup(documents, keep=keep, fan_in=2).collect()
    assert len(found) == documents.count()
    choose = max if keep == "largest" else min
    kept = Counter()
    for r in found:
        text = r.text or ""
        known = [i for i in groups[text] if i is not None]
        assert (r.keep_id, r.group_size) == (choose(known), len(groups[text]))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert not r.kept or r.doc_id == r.keep_id
        assert (r.id, r.n) in (("id", 1.5), (None, None))  # columns of the input with clashing names
        kept[text] += r.kept
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert exact_dedup(nothing).count() == 0
    with pytest.raises(ValueError, match="largest or smallest"):
        exact_dedup(documents, keep="first")


def test_the_exact_dedup_plan_has_no_python(documents):
    plan = exact_dedup(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_a_group_with_a_third_of_the_rows_is_dealt_out(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text")
    )
    found = exact_dedup(rows)
    assert found.where("text = 'same' and keep_id = 2997 and group_size = 1000").count() == 1000
    assert found.where("kept").count() == 2001
    placed = shard(rows, shards=4)
    sums = placed.groupBy("shard").agg(F.sum("size").alias("s"), F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert all(r.m == r.n - 1 for r in sums)  # the group is over a shard and so is split
    assert max(r.s for r in sums) - min(r.s for r in sums) < 0.02 * sum(r.s for r in sums)


def test_sharding(documents, nothing):
    placed = shard(documents, shards=3).collect()
    want = Counter((i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows_of(documents))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in placed) == want
    slots = defaultdict(list)
    for r in placed:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= {0, 1, 2}
    small = [r for r in placed if r.size < 5000]
    assert all(len({r.shard for r in small if r.text_crc32 == c}) == 1 for c in {r.text_crc32 for r in small})
    assert shard(nothing).count() == 0


def test_many_small_groups_are_balanced(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.expr("repeat(concat(id, ' '), 1 + int(id % 97))").alias("text"))
    placed = shard(rows, shards=8)
    words = F.col("doc_id") % 97 + 1
    sums = placed.groupBy("shard").agg(F.sum("size").alias("size"), F.sum(words).alias("words"), F.count("*").alias("n")).collect()
    for name, apart in (("size", 0.001), ("words", 0.005), ("n", 0.02)):
        some = [r[name] for r in sums]
        assert max(some) - min(some) < apart * sum(some) / 8, (name, some)


def test_tokens_are_words_or_letters_without_spaces(spark):
    texts = ["", "a b", "a\tb\nc  d", "日本語", "ab日本 c", "ไทย x", " \n", "über é"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in df.select(F.regexp_count("text", F.lit(TOKEN))).collect()]
    assert found == [0, 2, 4, 3, 4, 4, 0, 2]


def test_length_histogram(documents, nothing):
    lengths = [len(ids_of(BYTES, t)) for _, t in rows_of(documents)]
    found = length_histogram(documents, BYTES)
    rows = {r.length: r for r in found.collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert r.documents == lengths.count(n) and r.tokens == n * r.documents
        assert r.documents_at_least == sum(x >= n for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_total == sum(min(x, n) for x in lengths)
        assert r.share_up_to == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    assert truncated_total(found, 100) == sum(min(x, 100) for x in lengths)
    assert quantile(found, 0.5) == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]
    assert length_histogram(nothing, BYTES).count() == 0


def test_token_files(spark, documents, nothing):
    path = scratch_path(spark, "tokens")
    write_tokens(documents, BYTES, path, end_id=7)
    found = read_tokens(spark, path).orderBy("start").collect()
    want = Counter((i, tuple([*ids_of(BYTES, t), 7])) for i, t in rows_of(documents))
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == want
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda i: -1 if i is None else i)
    start = 0
    for r in found:
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(r.ids), checksum(r.ids))
        start += r.n_tokens
    thin = read_tokens(spark, path, ids=False)
    assert "ids" not in thin.columns and thin.count() == len(found)
    empty = scratch_path(spark, "tokens")
    write_tokens(nothing, BYTES, empty)
    assert read_tokens(spark, empty).count() == 0


def test_packing(documents, nothing):
    packed = pack_documents(documents, WORDS, capacity=256, ids=True).cache()
    found = packed.collect()
    want = Counter()
    for i, t in rows_of(documents):
        ids = [*ids_of(WORDS, t), 0]
        want.update((i, k // 256, k, checksum(ids[k : k + 256])) for k in range(0, len(ids), 256))
    assert Counter((r.doc_id, r.piece, r.start, r.ids_crc32) for r in found) == want
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for some in bins.values():
        some.sort()
        assert [o for o, *_ in some] == np.cumsum([0, *(n for _, n, _ in some)])[:-1].tolist()
        assert sum(n for _, n, _ in some) <= 256
    assert len(bins) <= 1 + math.ceil(sum(r.length for r in found) / 256)
    whole = {r.sequence_id: bytes(r.ids) for r in sequences(packed).collect()}
    assert whole == {s: b"".join(x for *_, x in some) for s, some in bins.items()}
    assert pack_documents(nothing, WORDS).count() == 0


def test_sentencepiece(documents, nothing):
    sentencepiece = pytest.importorskip("sentencepiece")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = sentencepiece_codec.encode(documents, PIECES).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == Counter(
        (i, tuple(library.encode(t)), t) for i, t in rows_of(documents)
    )
    assert all(r.n_ids == len(r.ids) and r.ids_crc32 == checksum(r.ids) for r in found)
    assert sentencepiece_codec.encode(nothing, PIECES, decode=False).count() == 0


def plain_fingerprint(text, k):
    words = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    shingles = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)][: len(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("radius", [4, 1])
def test_simhash(documents, nothing, radius):
    rows = rows_of(documents)
    prints = [plain_fingerprint(t, 4) for _, t in rows]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    least = least_reachable(n, pairs, [i for i, _ in rows])
    found = simhash_groups(documents, shingle=4, radius=radius).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        (i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, least, strict=True)
    )
    assert {c for (i, _), c in zip(rows, least, strict=True) if i in (3, 43, 44, 45)} == {3}
    assert simhash_groups(nothing).count() == 0


def test_a_large_bucket_is_split(spark, monkeypatch):
    from tradewind.llm import simhash

    monkeypatch.setattr(simhash, "LANES", 16)
    values = [(1 << 60) + (i << 8) for i in range(150)]
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = [(r.a, r.b) for r in simhash.link_fingerprints(df, 2).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    every = [(i, j) for i in range(150) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 2]
    at = {v: i for i, v in enumerate(values)}
    names = list(range(150))
    assert least_reachable(150, [(at[a], at[b]) for a, b in found], names) == least_reachable(150, every, names)


def test_embeddings(spark, monkeypatch):
    from tradewind.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "TILE", 40)
    draw = np.random.default_rng(1)
    base = draw.normal(size=(30, 16))
    vectors = np.concatenate([base, *(base[:15] + s * draw.normal(size=(15, 16)) for s in (0.05, 0.12, 0.2, 0.3))])
    rows = [(i, v.tolist(), i % 15 % 3) for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n + i, vectors[2].tolist(), 2) for i in range(25)]  # equal vectors
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0] * 3]
    rows += [(n + 25 + i, v, 0) for i, v in enumerate(odd)]
    rows += [(n + 40, vectors[0].tolist(), None), (n + 41, (1e300 * vectors[0]).tolist(), 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, n string, sound string")
    names = [r[0] for r in rows]

    def sound(r):
        return r[2] is not None and bool(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    unit = [np.array(r[1]) / np.abs(r[1]).max() if sound(r) else None for r in rows]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
        and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98
    ]
    links = Counter(x for p in pairs for x in p)
    least = least_reachable(len(rows), pairs, names)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_groups(df, 0.98).collect()}
    assert found == {x: (links[i], least[i], least[i] == x) for i, x in enumerate(names)}
    assert 100 < len(pairs)
    assert embedding_groups(df.limit(0)).count() == 0


def test_quality(spark, documents, nothing):
    scored = quality(documents, train_rows=100).collect()
    assert len(scored) == documents.count() and all(0 <= r.quality_score <= 1 for r in scored)
    assert scored[0].asDict().keys() == {*documents.columns, "quality_score", "accepted"}
    assert quality(nothing).count() == 0
    _, weights = fit(documents, train_rows=100)  # every row scored on its own, in plain Python
    for r in scored:
        line = sum(value * weights[place] for place, value in plain_features(r.text or "")) + weights[-1]
        assert r.quality_score == pytest.approx(1 / (1 + math.exp(-line)), abs=1e-9) and r.accepted == (r.quality_score >= 0.5)


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = quality(docs).join(labels, "doc_id")
    right = judged.agg(
        F.avg((F.col("accepted") == (F.col("quality") == 1)).cast("int")).alias("all"),
        F.avg(F.when(F.col("quality") == 1, F.col("accepted").cast("int"))).alias("clean_kept"),
    ).first()
    assert right["all"] > 0.97 and right["clean_kept"] > 0.99


def test_repeated_passages(documents, nothing, texts):
    found = repeated_passages(documents, least=50).collect()
    words = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    covered = defaultdict(set)
    unnamed = [r for r in found if r.doc_id is None]  # has the text of 6, and comes behind it
    n = len(words[6])
    assert [tuple(r)[1:] for r in unnamed] == [(0, n, 6, 0, n, n)] * (n >= 50)
    for r in found:
        if r.doc_id is None:
            continue
        assert r.source_id < r.doc_id and r.end_word - r.start_word >= 50
        assert r.matched >= 0.8 * (r.end_word - r.start_word)
        covered[r.doc_id].update(range(r.start_word, r.end_word))
    seen = {}
    repeats = defaultdict(set)
    for i in sorted(words):  # brute force: every run of 50 words that an earlier document has
        for k in range(len(words[i]) - 49):
            if seen.setdefault(tuple(words[i][k : k + 50]), i) != i:
                repeats[i].update(range(k, k + 50))
    assert repeats and all(repeats[i] <= covered[i] for i in repeats)
    assert set(covered) == {*repeats, 70}  # 70 has the passage with one word changed
    assert len(covered[70] - set(range(25, 95))) <= 2 and len(covered[70]) >= 70
    assert repeated_passages(nothing).count() == 0


def test_cut_passages(documents, texts):
    cut = {r.doc_id: r for r in cut_passages(documents, least=50).collect()}
    assert cut[60].text == texts[60] and cut[40].text is None and cut[42].text == texts[42]
    for i in range(61, 66):
        words = texts[i].split()
        kept = words[: 30 + i - 60] + words[-20:]
        assert cut[i].text.split() == kept and cut[i]["n"] == 1.5
    assert cut[49].text.split() == ["tail"] and (None in cut) == (len(texts[6].split()) < 50)
    gone = set(texts) - set(cut)
    assert gone and all(texts[i] in [t for j, t in texts.items() if j < i] or texts[i].lower() == texts[3] for i in gone)


def test_passages_are_cut_out_once(documents):
    plan = cut_passages(documents)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1

"""The pipeline, stage by stage, against brute force on the smallest test table with awkward rows added."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from tests.llm.test_operators import WORDS, checksum, ids_of, least_reachable, plain_fingerprint
from tradewind.llm.common import stored
from tradewind.llm.quality import quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows after each stage, the raw documents first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9001, None, None, None, None), (9002, "", "en", "x", 0), (9003, None, "en", "x", None)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    tables = [stored(docs.withColumns({"kept": F.lit("k"), "row": F.lit(1), "id": F.lit("i")}), "raw")]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF), name))
    return [t.collect() for t in tables], tables


def test_all_but_the_last_keep_the_columns(kept):
    _, tables = kept
    assert all(t.dtypes == tables[0].dtypes for t in tables[1:-1])


def test_rejected_documents_go(kept):
    (raw, accepted, *_), (docs, *_) = kept
    good = {r.doc_id for r in quality(docs).where("accepted").collect()}
    assert {r.doc_id for r in accepted} == good and 0 < len(accepted) < len(raw)


def test_of_equal_texts_the_largest_id_stays(kept):
    (_, before, after, *_), _ = kept
    groups = defaultdict(list)
    for r in before:
        groups[r.text or ""].append(r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(max(g) for g in groups.values())


def test_one_of_each_fingerprint_group_stays(kept):
    (_, _, before, after, *_), _ = kept
    prints = [plain_fingerprint(r.text or "", 4) for r in before]
    n, names = len(before), [r.doc_id for r in before]
    pairs = [(i, j) for i in range(n) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    assert sorted(r.doc_id for r in after) == sorted(set(least_reachable(n, pairs, names)))
    texts = {r.doc_id: r.text for r in before}
    assert all(texts[r.doc_id] == r.text for r in after)


def test_repeats_are_cut_and_nothing_else(kept):
    (*_, before, after, _), _ = kept
    left = {r.doc_id: r for r in after}
    seen: set[tuple] = set()
    for r in sorted(before, key=lambda r: r.doc_id):
        words = (r.text or "").encode().lower().split()
        runs = [tuple(words[i : i + 50]) for i in range(len(words) - 49)]
        new = (left[r.doc_id].text or "").encode().lower().split() if r.doc_id in left else []
        if not seen.intersection(runs) and r.doc_id in left and len(new) == len(words):
            assert left[r.doc_id].text == r.text
        if r.doc_id in left and left[r.doc_id].text is not None:
            assert left[r.doc_id].n_chars == len(left[r.doc_id].text)
        remaining = {tuple(new[i : i + 50]) for i in range(len(new) - 49)}
        assert not remaining & seen
        seen.update(runs)


def test_packing_takes_every_token(kept):
    (*_, docs, pieces), _ = kept
    whole = defaultdict(list)
    for p in pieces:
        whole[p.doc_id].append((p.start, p.ids_crc32, np.frombuffer(p.ids, "<u4").tolist()))
    assert set(whole) == {r.doc_id for r in docs}
    for r in docs:
        parts = sorted(whole[r.doc_id])
        assert [x for *_, ids in parts for x in ids] == [*ids_of(WORDS, r.text or ""), 0]
        assert all(crc == checksum(ids) for _, crc, ids in parts)
    total = defaultdict(int)
    for p in pieces:
        total[p.sequence_id] += p.length
    assert max(total.values()) <= 2048 and len(total) <= 1 + -(-sum(total.values()) // 2048)


STAGES = dict(corpus_pipeline.STAGES)
KIND = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def rows_after(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), "k") for i, t in rows], KIND).repartition(3)
    found = STAGES[stage](spark, stored(docs, "rows"), SF)
    assert found.columns == docs.columns
    return [(r.doc_id, r.text) for r in found.collect()]


def by_row(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or ""))


def test_near_copies_go_by_row_whatever_their_ids(spark):
    draw = random.Random(6)
    one, two, three, four = (prose(draw, 100) for _ in range(4))
    rows = [(1, one), (None, one.upper()), (None, two), (2, three), (5, three.upper()), (5, four), (6, None), (7, " "), (None, None)]
    assert by_row(rows_after(spark, "near_dedup", rows)) == by_row([(1, one), (None, two), (2, three), (5, four), (6, None)])


def test_equal_texts_go_by_row_whatever_their_ids(spark):
    draw = random.Random(7)
    one, two = prose(draw, 9), prose(draw, 9)
    rows = [(1, one), (1, two), (1, one), (None, one), (None, two), (None, None), (8, ""), (None, "x")]
    assert by_row(rows_after(spark, "exact_dedup", rows)) == by_row([(1, one), (1, two), (8, ""), (None, "x")])


def test_repeats_are_cut_by_row_whatever_their_ids(spark):
    draw = random.Random(8)
    passage = prose(draw, 70)
    around = lambda a, b: (prose(draw, a), prose(draw, b))
    first, second, unnamed, last = around(20, 30), around(200, 5), around(3, 90), around(40, 0)
    whole = lambda x: f"{x[0]} {passage} {x[1]}"
    cut = lambda x: f"{x[0]} {x[1]}"
    short, clean, long = prose(draw, 3), prose(draw, 300), prose(draw, 400)
    rows = [(1, whole(first)), (1, whole(second)), (None, whole(unnamed)), (9, whole(last)), (3, short), (3, clean)]
    rows += [(None, long), (4, long.upper()), (None, None), (5, None), (5, ""), (3, short), (None, passage), (4, passage.title())]
    found = by_row(rows_after(spark, "substring_dedup", rows))
    kept = [(None, cut(unnamed)), (9, cut(last)), (3, short), (3, clean), (4, long.upper())]
    kept += [(None, None), (5, None), (5, ""), (3, short)]
    either = [[(1, whole(first)), (1, cut(second))], [(1, cut(first)), (1, whole(second))]]
    assert found in [by_row(kept + x) for x in either]


def test_a_null_or_repeated_id_packs_and_scores_like_another(spark):
    rows = [(1, "a b"), (1, "c d"), (None, "a b"), (None, None), (2, "")]
    docs = spark.createDataFrame([(i, t, None, "s", 1, "k") for i, t in rows], KIND)
    found = STAGES["best_fit_packing"](spark, docs, SF).collect()
    want = [(i, checksum([*ids_of(WORDS, t or ""), 0])) for i, t in rows]
    assert by_row((r.doc_id, str(r.ids_crc32)) for r in found) == by_row((i, str(x)) for i, x in want)
    scored = quality(docs).collect()
    assert by_row((r.doc_id, r.text) for r in scored) == by_row(rows)


@pytest.mark.parametrize("stage", STAGES)
def test_an_empty_table_stays_empty(spark, stage):
    assert STAGES[stage](spark, spark.createDataFrame([], KIND), SF).count() == 0

"""Centroid clustering against all distances in plain integers."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm.centroids import VpTree, clusters


def plain_clusters(rows, k, rounds, size, scale, salt="2:"):
    """Rows of the result for ``(id, vector)``."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(scale * x) for x in v]))
    digest = lambda i: hashlib.sha256(f"{salt}{i}".encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else digest(r[0]), r[1]))
    centroids = [v for _, v in first[:k]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    nearest = lambda v: min((away(v, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for n, some in members.items():
            centroids[n] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, d, inertia[n], sum(inertia.values()), sha[n]) for i, d, n in found)


@pytest.mark.parametrize(("k", "spread"), [(1, 5), (2, 3), (7, 2), (40, 3), (40, 100), (90, 1)])
def test_the_tree_finds_the_nearest_and_smallest(k, spread):
    draw = np.random.default_rng(k + spread)
    centroids = draw.integers(-spread, spread + 1, (k, 6))  # many equal distances, and equal centroids
    vectors = draw.integers(-spread, spread + 1, (500, 6))
    away = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
    number, best = VpTree.build(centroids, leaf=1 + k % 3).nearest(vectors)
    assert (number == away.argmin(axis=1)).all() and (best == away.min(axis=1)).all()


def test_the_tree_leaves_out_what_is_far(monkeypatch):
    draw = np.random.default_rng(3)
    centroids = draw.integers(-1000, 1000, (64, 2))
    vectors = draw.integers(-1000, 1000, (300, 2))
    seen = Counter()
    from tradewind.llm import centroids as module

    def counted(some, centroid, plain=module.squares):
        seen["n"] += len(some)
        return plain(some, centroid)

    tree = VpTree.build(centroids)
    monkeypatch.setattr(module, "squares", counted)
    number, _ = tree.nearest(vectors)
    assert (number == ((vectors[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert seen["n"] < len(vectors) * len(centroids) / 3


def test_far_vectors_are_exact():
    big = (1 << 27) - 1
    centroids = np.array([[big] * 64, [-big] * 64, [big] * 63 + [big - 1]])
    number, best = VpTree.build(centroids, leaf=1).nearest(np.array([[-big] * 64, [big] * 63 + [big - 2]]))
    assert number.tolist() == [1, 2] and best.tolist() == [0, 1]


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    vector = lambda: [draw.choice([-1.25, -0.5, -0.26, 0.0, 0.3, 0.999]) for _ in range(4)]
    found = [(i, vector()) for i in range(200)]
    found += [(7, vector()), (8, found[8][1]), (None, vector()), (None, None), (300, None), (301, []), (302, [1.0] * 5)]
    return found + [(303, [0.5, None, 0.5, 0.5]), (304, [math.nan] * 4), (305, [math.inf, 0.0, 0.0, 0.0]), (306, [0.0] * 4)]


@pytest.mark.parametrize("k", [1, 12, 500])
def test_awkward_rows(spark, rows, k):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    table = table.withColumns({"v": F.lit("x"), "cluster": F.lit(None), "Distance": F.lit(1.5)})
    found = Counter(map(tuple, clusters(table, k=k, rounds=3, size=4, scale=8).collect()))
    assert found == plain_clusters(rows, k, 3, 4, 8)


def test_nothing_to_keep(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = clusters(table, size=4)
    for some in (table.limit(0), table.where("vec_id > 299 and vec_id < 306")):
        found = clusters(some, size=4)
        assert found.collect() == [] and found.dtypes == whole.dtypes


def test_a_component_that_does_not_fit_raises(spark):
    table = spark.createDataFrame([(1, [1e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="not below"):
        clusters(table, size=1)
    with pytest.raises(ValueError, match="128"):
        clusters(table, size=129)

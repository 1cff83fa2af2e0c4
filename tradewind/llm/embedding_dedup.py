"""Embedding near-deduplication by int8 tile products with error bounds.

Vectors of one label are compared in tiles of two blocks. Each unit vector is rounded to int8 with a scale of its own;
the norm of what the rounding left bounds the error of every product exactly. Pairs that could reach the threshold are
computed again in double precision, and only those decide. A tile returns counts and a spanning forest per vector, never
its pairs. Equal vectors are one from the start, so copies cost nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import components, stored

TILE = 2048
# Sums of so many int8 products are exact in single precision.
_EXACT = 1024
_SLACK = 1e-9  # above what double precision rounds in the bounds
_PAIRS = 1 << 18


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales, the norms of what the codes stand for, and of the rest."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.linalg.norm(near, axis=1), np.linalg.norm(unit - near, axis=1)


def possible(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of unit vectors whose cosine may reach the threshold, from int8 products alone."""
    (qa, sa, na, ea), (qb, sb, _, eb) = quantise(a), quantise(b)
    product = np.zeros((len(a), len(b)))
    for i in range(0, a.shape[1], _EXACT):
        product += qa[:, i : i + _EXACT].astype(np.float32) @ qb[:, i : i + _EXACT].astype(np.float32).T
    product *= sa[:, None] * sb
    product += na[:, None] * eb + ea[:, None]  # <x, y> = <x', y'> + <x', y - y'> + <x - x', y>
    return np.nonzero(product >= threshold - _SLACK)


def linked(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of unit vectors whose cosine is at least the threshold, in double precision."""
    i, j = possible(a, b, threshold)
    step = max(1, _PAIRS // max(1, a.shape[1] // 64))
    sure = [
        np.einsum("ij,ij->i", a[i[k : k + step]], b[j[k : k + step]]) >= threshold for k in range(0, len(i), step)
    ]
    hit = np.concatenate(sure) if sure else np.zeros(0, dtype=bool)
    return i[hit], j[hit]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the least one that the links between ``i`` and ``j`` reach."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def embedding_groups(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    Vectors with the same label, which isn't null, are linked when their cosine is at least ``threshold``. Vectors that
    are null, empty or zero, that hold null or non-finite numbers, have no label or no id, link with nothing; nor do
    vectors of different lengths. ``component_id`` is the least id reachable and ``kept`` says that it is the row's own.
    Rows that repeat an id are vectors of their own for ``n_links`` and one for what is reachable. An empty table gives
    an empty result, and other columns are not looked at.
    """
    rows = vectors.select(
        vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].alias("vector")
    )
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    sound = (
        F.col("id").isNotNull()
        & F.col("label").isNotNull()
        & F.coalesce(F.forall("vector", number) & F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    classes = stored(rows.where(sound).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("n")), "vectors")
    shape = ["label", "dim"]
    sized = classes.withColumn("dim", F.size("vector"))
    blocks = sized.groupBy(*shape).agg(F.ceil(F.count("*") / TILE).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("vector"), F.col("blocks")).cast("int")
    dealt = (
        sized.join(blocks, shape)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*shape, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "n", "vector")
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def compare(table: pa.Table) -> pa.Table:
        ids, n, block = table.column("id").combine_chunks(), table.column("n").to_numpy(), table.column("own").to_numpy()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        unit = flat.reshape(len(n), -1)
        unit = unit / np.abs(unit).max(axis=1)[:, None]  # no overflow in the norm
        unit /= np.linalg.norm(unit, axis=1)[:, None]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = linked(unit[a], unit[b], threshold)
        i, j = a[i], b[j]
        if low == high:
            i, j = i[i < j], j[i < j]
        links = np.bincount(i, n[j], len(n)) + np.bincount(j, n[i], len(n))
        order = np.argsort(ids.to_numpy(zero_copy_only=False), kind="stable")  # the least id of a tree is its root
        place = np.empty(len(n), dtype=np.int64)
        place[order] = np.arange(len(n))
        root = order[forest(len(n), place[i], place[j])[place]]
        hit = np.flatnonzero(links)
        return pa.table(
            {"id": ids.take(pa.array(hit)), "links": pa.array(links[hit].astype(np.int64)), "root": ids.take(pa.array(root[hit]))}
        )

    tiles = dealt.groupBy(*shape, "low", "high").applyInArrow(compare, f"id {id_type}, links long, root {id_type}")
    tiles = stored(tiles, "vector-links")
    counts = tiles.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(tiles, "id", "root", "id", "component")
    found = classes.join(counts, "id", "left").join(groups, "id", "left")
    found = found.select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
        F.coalesce("component", "id").alias("component"),
    )
    joined = rows.withColumn("sound", sound).join(found.withColumn("sound", F.lit(True)), ["sound", "label", "vector"], "left")
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )

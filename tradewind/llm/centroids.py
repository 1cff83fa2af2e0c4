"""Centroid clustering of integer vectors, each assigned by a search in a vantage-point tree over the centroids.

The centroids are few and stay on the driver; each round they are put in a new tree, which is broadcast. A node of the
tree holds a centroid, the vantage point, and two children: the centroids nearer to it and those further away, each with
the least and the greatest distance of its members. A vector visits the nodes in order of the least distance that any of
their centroids can have by the triangle inequality, and ends when that exceeds the distance of the best centroid so
far. Equal bounds are still visited, so that of centroids at one distance the smallest number is found. Distances are
compared as exact integers, and bounds are lowered by more than a root's rounding. All vectors of a batch search at once,
each in its own order.

Vectors stay in Spark. A round sends home one sum for each component of each centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import stored

LEAF = 3
ROWS = 4096
# Components below it in size, so that squared distances of up to 128 components fit in 64 bits.
LIMIT = 1 << 27
_SLACK = 1e-9  # of the distances in a bound; a root is off by less than 1e-15 of itself


def squares(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances."""
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


@dataclass
class VpTree:
    """``members`` of each node: the vantage point alone, or the centroids of a leaf. ``children``: node, low, high."""

    centroids: np.ndarray
    members: list[np.ndarray] = field(default_factory=list)
    children: list[list[tuple[int, float, float]]] = field(default_factory=list)

    @classmethod
    def build(cls, centroids: np.ndarray, leaf: int = LEAF) -> VpTree:
        tree = cls(centroids)
        tree._node(np.arange(len(centroids)), leaf)
        return tree

    def _node(self, some: np.ndarray, leaf: int) -> int:
        own = len(self.members)
        if len(some) <= leaf:
            self.members.append(some)
            self.children.append([])
            return own
        # The centroid furthest from the first one sees the others at the most different distances.
        far = int(np.argmax(squares(self.centroids[some], self.centroids[some[0]])))
        rest = np.delete(some, far)
        away = squares(self.centroids[rest], self.centroids[some[far]])
        order = np.argsort(away, kind="stable")
        self.members.append(some[far : far + 1])
        self.children.append([])
        for part in filter(len, np.array_split(order, 2)):
            low, high = np.sqrt(away[part[[0, -1]]].astype(np.float64))
            self.children[own].append((self._node(np.sort(rest[part]), leaf), float(low), float(high)))
        return own

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the number of the nearest centroid, the smallest of equally near ones, and its squared distance."""
        n = len(vectors)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.centroids), np.int64)
        bounds = np.full((n, len(self.members)), np.inf)
        bounds[:, 0] = 0
        searching = np.arange(n)
        while len(searching):
            node = bounds[searching].argmin(axis=1)
            low = bounds[searching, node]
            going = low <= np.sqrt(best[searching].astype(np.float64))
            searching, node, low = searching[going], node[going], low[going]
            for at in np.unique(node).tolist():
                rows, least = searching[node == at], low[node == at]
                bounds[rows, at] = np.inf
                for member in self.members[at].tolist():
                    away = squares(vectors[rows], self.centroids[member])
                    nearer = (away < best[rows]) | ((away == best[rows]) & (member < number[rows]))
                    best[rows[nearer]], number[rows[nearer]] = away[nearer], member
                if self.children[at]:  # then the node has one member, and ``away`` is the vantage point's
                    seen = np.sqrt(away.astype(np.float64))
                    for child, near, far in self.children[at]:
                        bound = np.maximum(seen - far, near - seen) - _SLACK * (seen + far + 1)
                        bounds[rows, child] = np.maximum(bound, least)
            searching = searching[np.isfinite(bounds[searching]).any(axis=1)]
        return number, best


def integer_vectors(table: DataFrame, size: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v``: the vectors of exactly ``size`` finite components as floor(``scale`` * x). Others are left out."""
    whole = table[vector_col].cast("array<double>")
    odd = F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    far = F.raise_error(F.lit(f"a component times {scale} is not below {LIMIT}")).cast("long")
    down = F.transform(whole, lambda x: F.when(F.abs(scale * x) < LIMIT, F.floor(scale * x)).otherwise(far))
    return table.where((F.size(whole) == size) & ~odd).select(table[id_col].cast("long").alias("vec_id"), down.alias("v"))


def _vectors(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """For each centroid that is nearest to any vector, the sum of each component of those, and their number."""
    k, size = centroids.shape
    tree = vectors.sparkSession.sparkContext.broadcast(VpTree.build(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, size + 1), np.int64)
        for _, some in _vectors(batches, size):
            number, _ = tree.value.nearest(some)
            order = np.argsort(number, kind="stable")
            found, starts, counts = np.unique(number[order], return_index=True, return_counts=True)
            if len(found):
                total[found, :size] += np.add.reduceat(some[order], starts, axis=0)
                total[found, size] += counts
        cluster, at = np.nonzero(np.broadcast_to(total[:, size :] > 0, total.shape))
        columns = [pa.array(c.astype(np.int64)) for c in (cluster, at, total[cluster, at])]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "at", "total"])

    parts = vectors.mapInArrow(run, "cluster long, at long, total long")
    out: dict[int, list[int]] = {}
    for r in parts.groupBy("cluster", "at").agg(F.sum("total").alias("total")).collect():  # k * (size + 1) rows at most
        out.setdefault(r.cluster, [0] * (size + 1))[r.at] = r.total
    tree.unpersist()
    return out


_RESULT = T.StructType(
    [T.StructField(c, t) for c, t in (
        ("vec_id", T.LongType()), ("cluster", T.IntegerType()), ("distance", T.LongType()),
        ("cluster_inertia", T.LongType()), ("inertia", T.LongType()), ("centroid_sha256", T.StringType()),
    )]
)


def clusters(
    table: DataFrame,
    k: int = 40,
    rounds: int = 5,
    size: int = 64,
    scale: int = 256,
    salt: str = "2:",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: ``vec_id``, ``cluster``, squared ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors of exactly ``size`` components, none null or not finite, are kept, as integers floor(``scale`` * x). The
    centroids start as the ``k`` of them whose ``salt`` and id have the least sha256, null ids last (of rows with one id,
    the least vectors first); with fewer vectors there are fewer centroids. In each round all vectors go to their nearest
    centroid, the smallest number of equally near ones, and every centroid with vectors moves to their exact mean, rounded
    down. Then they are assigned once more. The digest is that of the final centroid's components, joined by commas.

    Ids may be null or repeat: each row is a vector. Without vectors to keep, as with an empty table, the result is empty.
    A component whose integer is 2**27 or more in size raises, as distances would not fit in a long. Other columns are
    not looked at.
    """
    if size > 128:
        raise ValueError("more than 128 components")
    spark = table.sparkSession
    vectors = stored(integer_vectors(table, size, scale, id_col, vector_col), "integer-vectors")
    digest = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    first = vectors.orderBy(digest.asc_nulls_last(), "v").limit(k).collect()  # k vectors
    if not first:
        return spark.createDataFrame([], _RESULT)
    centroids = np.array([r.v for r in first], dtype=np.int64).reshape(-1, size)
    for _ in range(rounds):
        for cluster, (*total, n) in _sums(vectors, centroids).items():
            centroids[cluster] = [x // n for x in total]

    tree = spark.sparkContext.broadcast(VpTree.build(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in _vectors(batches, size):
            number, best = tree.value.nearest(some)
            columns = [part.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(best)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    assigned = stored(vectors.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum("distance")).collect())  # k rows at most
    named = [
        (c, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c, n in inertia.items()
    ]
    about = spark.createDataFrame(named, T.StructType([_RESULT["cluster"], *_RESULT.fields[3:]]))
    return assigned.join(F.broadcast(about), "cluster").select(*_RESULT.names)

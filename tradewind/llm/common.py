"""Helpers that several corpus operators share: stored tables, fresh column names, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.sources.scratch import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared scratch folder and read again: cuts the lineage, survives executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, which follows the size of its data."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores put in front until ``df`` has no column of that name, in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The columns of ``df`` but for ``names``, compared without case."""
    dropped = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in dropped]


def slices(batches: Iterable[pa.RecordBatch], text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that one holds about ``most`` bytes of text, or a single row: bounds a worker's memory."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, int(rows * most / max(1, batch.column(text).nbytes)))
        for i in range(0, rows, step):
            yield batch.slice(i, step)


def _edges(df: DataFrame) -> DataFrame:
    return df.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str, node: str, component: str) -> DataFrame:
    """The connected components of an undirected graph: one row per node that has a link, with its least reachable node.

    Alternates large-star and small-star steps until the edges stay as they are: after that each node points at the
    least node of its component. Each step is a grouped minimum, combined before the shuffle, and a join back to the
    edges, which adaptive execution splits where one node has very many. Every round is written to the shared folder.
    Links of a node to itself, repeated links and links with a null end change nothing.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    edges = stored(_edges(edges), "links")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _edges(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(_edges(small.union(least.select("u", F.col("m").alias("v")))), "links")
    members = edges.groupBy("u").agg(F.min("v").alias("v"))
    roots = edges.select("v").distinct().select(F.col("v").alias("u"), "v")
    return members.union(roots).select(F.col("u").alias(node), F.col("v").alias(component))

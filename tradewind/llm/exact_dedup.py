"""Exact deduplication by a tree merge of digest runs, in DataFrame operations only.

Documents are dealt into runs by a hash of their id. A run holds one entry per text: digest, count and the id that would
stay. In each round ``fan_in`` neighbouring runs are exchanged by digest and merged in sorted order; of the entries for
one text the first stays with the summed count. The last round leaves one run, spread over all tasks by digest. The
result then goes back down the same tree, so that no join meets more than ``fan_in`` entries for one text, however many
copies it has. Only digests travel; texts are read where they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import partitions, stored, text_or_empty, without

# Two texts are one when all three agree: digest, length in bytes, and a second hash.
KEY = ["sha", "size", "check"]
OUT = ("keep_id", "group_size", "kept", "text_sha256")
_ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.BinaryType)


def _order(keep: str, c: str) -> Column:
    return F.col(c).desc_nulls_last() if keep == "largest" else F.col(c).asc_nulls_last()


def merge(level: DataFrame, fan_in: int, keep: str) -> DataFrame:
    """One round: the runs of each ``fan_in`` neighbours as one sorted run."""
    level = level.withColumn("run", F.floor(F.col("run") / fan_in))
    same = W.partitionBy("run", *KEY)
    ranked = level.withColumns(
        {"place": F.row_number().over(same.orderBy(_order(keep, "best"))), "n": F.sum("n").over(same)}
    )
    return ranked.where("place = 1").drop("place")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest", fan_in: int = 8
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical; a null text counts as empty. Of equal texts the row with the ``largest`` (or
    ``smallest``) id stays; a null id stays only where all ids of the group are null. Rows that repeat both id and text
    count each, and one of them stays: the least by the other columns, any one if those agree too. An empty table gives
    an empty result. Input columns named like the four output columns are replaced.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep is largest or smallest, not {keep}")
    text = text_or_empty(docs[text_col])
    others = [docs[c] for c in without(docs, OUT)]
    rows = docs.select(
        F.struct(*others).alias("row"),
        docs[id_col].alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).alias("size"),
        F.xxhash64(text).alias("check"),
    )
    rounds, runs = 1, fan_in
    while runs < partitions(docs):
        rounds, runs = rounds + 1, runs * fan_in
    rows = rows.withColumn("run", F.pmod(F.xxhash64("id"), F.lit(runs)))
    best = F.max("id") if keep == "largest" else F.min("id")
    leaf = rows.groupBy("run", *KEY).agg(best.alias("best"), F.count("*").alias("n"))
    levels = [stored(leaf, "digest-runs")]
    for _ in range(rounds - 1):  # each level is read again on the way down
        levels.append(stored(merge(levels[-1], fan_in, keep), "digest-runs"))
    decided = merge(levels[-1], fan_in, keep)
    for level in reversed(levels):
        entries = level.select(F.col("run").alias("own"), F.floor(F.col("run") / fan_in).alias("run"), *KEY)
        decided = entries.join(decided, ["run", *KEY]).drop("run").withColumnRenamed("own", "run")

    tie = [
        F.col("row")[f.name]
        for f in docs.schema
        if f.name in without(docs, (*OUT, id_col, text_col)) and isinstance(f.dataType, _ORDERED)
    ]
    first = F.row_number().over(W.partitionBy("run", *KEY, "id").orderBy(*(tie or [F.lit(0)]))) == 1
    joined = rows.join(decided, ["run", *KEY]).withColumn("kept", F.col("id").eqNullSafe(F.col("best")) & first)
    return joined.select(
        "row.*",
        F.col("best").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

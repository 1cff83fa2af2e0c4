"""Data-quality audits. Each is one aggregation over one scan and returns a table; none runs an action.

Counts are combined before the shuffle, so the last task gets one row per input task, however large the table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    """A quality rule: the rows it affects and what the cleaning does to them."""

    name: str
    affected: Column
    action: str


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def null_audit(df: DataFrame, table_name: str) -> DataFrame:
    """One row per column: how many NULLs it has out of how many rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count(_named(c)).alias(f"_filled_{i}") for i, c in enumerate(df.columns)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                (F.col("row_count") - F.col(f"_filled_{i}")).alias("null_count"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select("row_count", F.inline(per_column)).select(
        F.lit(table_name).alias("table_name"),
        "column_name",
        "null_count",
        "row_count",
        F.when(F.col("null_count") > 0, "WARNING").otherwise("INFO").alias("level"),
    )


def null_percentages(df: DataFrame) -> DataFrame:
    """One row: the percentage of NULLs in each column; NULL for an empty table."""
    rows = F.count(F.lit(1))
    return df.agg(
        *[(F.try_divide(F.sum(_named(c).isNull().cast("int")), rows) * 100).alias(c) for c in df.columns]
    )


def count_where(df: DataFrame, condition: Column, out: str = "n") -> DataFrame:
    """One row: the number of rows that meet the condition."""
    return df.agg(F.count_if(condition).alias(out))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once, with their count ``n``; empty if the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def quality_report(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: how many rows of the dataset it affects, and the action taken on them."""
    counts = df.agg(*[F.count_if(rule.affected).alias(f"_rule_{i}") for i, rule in enumerate(rules)])
    per_rule = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                F.lit(rule.name).alias("rule"),
                F.col(f"_rule_{i}").alias("affected_rows"),
                F.lit(rule.action).alias("action"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(per_rule))

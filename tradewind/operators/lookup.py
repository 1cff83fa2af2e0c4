"""Dictionary lookups: a fixed mapping joined as a small dimension, without Python UDFs or long CASE chains."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A mapping up to this size is broadcast. A larger one joins without a hint, so Spark decides by its size.
MAX_BROADCAST_ROWS = 10_000

_KEY = "_lookup_key"
_VALUE = "_lookup_value"


def dimension(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """The mapping as a two-column table, with a broadcast hint if it is small enough."""
    table = pa.table(
        {
            _KEY: pa.array(mapping.keys(), pa.string()),
            _VALUE: pa.array(mapping.values(), pa.string()),
        }
    )
    rows = spark.createDataFrame(table)
    return F.broadcast(rows) if len(mapping) <= MAX_BROADCAST_ROWS else rows


def lookup(df: DataFrame, mapping: Mapping[str, str], key: str, target: str, default: Column) -> DataFrame:
    """Set ``target`` to the mapped value of ``key``, or to ``default`` where ``key`` is NULL or not mapped.

    Keys of a mapping are unique, so the row count stays. An existing ``target`` keeps its position.
    """
    joined = df.join(dimension(df.sparkSession, mapping), F.col(key) == F.col(_KEY), "left")
    return joined.withColumn(target, F.coalesce(_VALUE, default)).drop(_KEY, _VALUE)


def unmapped_values(df: DataFrame, mapping: Mapping[str, str], key: str) -> DataFrame:
    """Distinct values of ``key`` that the mapping lacks. NULL is not listed."""
    values = df.select(key).where(F.col(key).isNotNull()).distinct()
    return values.join(dimension(df.sparkSession, mapping), F.col(key) == F.col(_KEY), "left_anti")


def correct_values(df: DataFrame, column: str, fixes: Mapping[str, str]) -> DataFrame:
    """Replace each wrong value by its right one; other values and NULL stay."""
    return df.replace(dict(fixes), subset=[column])

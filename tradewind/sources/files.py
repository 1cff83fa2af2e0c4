"""CSV and Parquet readers and writers."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.sources.datasets import DATASETS, Dataset

_MEASURES = ("double", "float", "decimal")


def read_csv(
    spark: SparkSession, path: str, types: Mapping[str, str] | None = None, infer: bool = False, multiline: bool = False
) -> DataFrame:
    """A CSV file with a header row. A header name that occurs twice gets its position appended (``OrderID14``).

    Columns are strings unless named in ``types``, which goes by header name without case, not by position, and holds
    for every copy of a repeated name. A declared column that the file lacks raises. Measures that do not parse become
    NULL; other types, such as keys, raise whatever the ANSI mode, so that no key is lost unseen. ``infer=True`` lets
    Spark guess the types instead, at the price of another pass over the file. With ``multiline`` a quoted value may
    hold line breaks; then a file is not split, so one task reads all of it.
    """
    if infer:
        return spark.read.csv(path, header=True, inferSchema=True, multiLine=multiline)
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=multiline)
    casts = {
        name: _typed(name, kind) for declared, kind in (types or {}).items() for name in _copies(df, declared, path)
    }
    return df.withColumns(casts) if casts else df


def _copies(df: DataFrame, declared: str, path: str) -> list[str]:
    """The columns of a declared name: that one, or its numbered copies."""
    found = [c for c in df.columns if c.lower() == declared.lower()]
    found = found or [c for c in df.columns if re.fullmatch(re.escape(declared) + r"\d+", c, re.IGNORECASE)]
    if not found:
        raise ValueError(f"{path} has no column {declared}")
    return found


def _typed(name: str, kind: str) -> Column:
    value = F.col(name).try_cast(kind)
    if kind.startswith(_MEASURES):
        return value
    complaint = F.concat(F.lit(f"{name} is no {kind}: "), F.col(name))
    bad = F.col(name).isNotNull() & value.isNull()
    return F.when(bad, F.raise_error(complaint).cast(kind)).otherwise(value)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row, replacing what the folder held. White space around values is kept."""
    df.write.mode("overwrite").csv(
        path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def table_path(lake: str, layer: str, name: str) -> str:
    return f"{lake.rstrip('/')}/{layer}/{name}"


def read_table(spark: SparkSession, lake: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(lake, layer, name))


def write_table(df: DataFrame, lake: str, layer: str, name: str) -> None:
    """Parquet, replacing the whole table."""
    df.write.mode("overwrite").parquet(table_path(lake, layer, name))


def land(
    spark: SparkSession,
    raw: str,
    lake: str,
    datasets: Mapping[str, Dataset] = DATASETS,
    infer: bool = False,
) -> None:
    """Copy each raw CSV file to its bronze table."""
    for dataset in datasets.values():
        df = read_csv(spark, f"{raw.rstrip('/')}/{dataset.csv_file}", dataset.types, infer)
        write_table(df, lake, "bronze", dataset.name)


def checked_csv(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, str]:
    """A CSV file as text, and the name of one column more: the whole line where it has fewer or more values than the header.

    ``read_csv`` fills such a row with NULL, or leaves out what is too much.
    """
    names = spark.read.csv(path, header=True, multiLine=multiline).columns
    line = "line"
    while line in names:
        line = "_" + line
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, line)])
    df = spark.read.schema(schema).csv(path, header=True, multiLine=multiline, columnNameOfCorruptRecord=line)
    # Asks for every column, as else Spark takes a line apart only as far as its wanted columns go.
    return df.where(F.length(F.concat_ws("", *names)) >= 0), line


def malformed_lines(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """The lines of a CSV file that have fewer or more values than its header: ``line``."""
    df, line = checked_csv(spark, path, multiline)
    return df.where(F.col(line).isNotNull()).select(F.col(line).alias("line"))


def landing_audit(spark: SparkSession, raw: str, datasets: Mapping[str, Dataset] = DATASETS) -> DataFrame:
    """For each raw CSV file ``table_name``, its ``n_rows``, and how many were ``n_malformed``; one scan a file."""
    found = []
    for dataset in datasets.values():
        df, line = checked_csv(spark, f"{raw.rstrip('/')}/{dataset.csv_file}")
        counts = df.agg(F.count("*").alias("n_rows"), F.count(line).alias("n_malformed"))
        found.append(counts.select(F.lit(dataset.name).alias("table_name"), "n_rows", "n_malformed"))
    return reduce(DataFrame.unionAll, found)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows, for looking at."""
    return df.limit(n)

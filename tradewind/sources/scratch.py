"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the session's ``spark.checkpoint.dir``; its files stay until you clear that folder.

    Without that setting it is the folder that ``SparkContext.setCheckpointDir`` was given, if it was called. On a cluster
    either must name a shared folder. A bare local path may be one, as a mount that all machines have, or a disk of each
    executor's own: it is tried out once, and refused if rows that executors write there do not come back. Without a folder
    a local session, as in tests, gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = named or _given_folder(spark)
    local = spark.conf.get("spark.master", "").split("[")[0] == "local"
    if not root and not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if root and not local:
        bare = "://" not in root and not root.startswith("file:") and not _has_default_store(spark)
        bare = bare or not named and root.startswith("file:")  # Spark puts that before what it was given
        if bare and not (isinstance(spark, SparkSession) and _comes_back(spark, root.rstrip("/"))):
            raise ValueError(f"spark.checkpoint.dir is {root}, a bare local path that is not shared: name its file system")
    root = root or tempfile.mkdtemp(prefix="tradewind-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def _given_folder(spark: SparkSession) -> str | None:
    """The folder that ``SparkContext.setCheckpointDir`` made, which does not show in the settings."""
    return spark.sparkContext.getCheckpointDir() if isinstance(spark, SparkSession) else None


def _has_default_store(spark: SparkSession) -> bool:
    """Whether paths without a scheme lie in a distributed store."""
    store = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:///"
    return not store.startswith("file:")


@cache
def _comes_back(spark: SparkSession, root: str) -> bool:
    """Whether rows that the executors write under ``root`` are all there when they are read."""
    path, n = f"{root}/trial-{uuid.uuid4().hex}", 4 * spark.sparkContext.defaultParallelism
    rows = spark.range(0, n, 1, n)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).count() == n

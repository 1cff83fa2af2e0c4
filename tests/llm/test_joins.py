"""What is broadcast when Spark sizes a table by what it was before an explode."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.llm import common, simhash
from tradewind.llm.common import stored
from tradewind.llm.simhash import link_fingerprints


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _broadcast(plan: str) -> list[str]:
    """What stands below each broadcast of a plan."""
    lines, found = plan.split("\n"), []
    for i, line in enumerate(lines):
        if at := re.match(r"[\s:+*()\d-]*BroadcastExchange", line):
            below = at.end() - len("BroadcastExchange")
            ends = (j for j in range(i + 1, len(lines)) if not re.match(rf"[\s:+*()\d-]{{{below + 1}}}", lines[j]))
            found.append("\n".join(lines[i + 1 : next(ends, len(lines))]))
    return found


def test_bucket_join_broadcasts_neither_side(spark):
    few = stored(spark.range(2000).select(F.xxhash64("id").alias("fp")), "few")
    plan = _plan(link_fingerprints(few, radius=4))
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_near_dedup_broadcasts_nothing_that_was_exploded(spark, documents, monkeypatch):
    plans = []

    def recorded(df, label):
        plans.append(_plan(df))
        return stored(df, label)

    for module in (common, simhash, corpus_pipeline):
        monkeypatch.setattr(module, "stored", recorded)
    plans.append(_plan(corpus_pipeline.without_near_copies(spark, documents, "")))
    sent = [below for plan in plans for below in _broadcast(plan)]
    assert sent and not any("Generate explode" in below for below in sent)

"""Token counts as an exact histogram of encoded lengths, with suffix sums for every context limit."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import slices, stored, text_or_empty
from tradewind.llm.encoding import encoder

# Lengths summed together first, so that no task has to order all of them.
BLOCK = 1024


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """The encoded length of every document, as ``length``; a null text is empty and has none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in slices(batches, "text"):
            lengths = [len(ids) // 4 for ids in own.encode(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], names=["length"])

    return docs.select(text_or_empty(docs[text_col]).alias("text")).mapInArrow(count, "length long")


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """One row per length that occurs, over all documents and whole texts.

    ``documents`` and ``tokens`` of that length; ``documents_at_least`` and ``tokens_at_least`` this long (suffix sums);
    ``truncated_total``: the tokens left when every document is cut to this length; ``share_up_to``: the share of
    documents of at most this length, from which any quantile is read. Null texts are empty (length 0), repeated rows
    count each, other columns are not looked at, and an empty table gives an empty result.
    """
    counts = token_counts(docs, tokenizer, text_col).groupBy("length").agg(F.count("*").alias("documents"))
    counts = stored(counts, "length-histogram").withColumns(
        {"tokens": F.col("length") * F.col("documents"), "block": F.floor(F.col("length") / BLOCK)}
    )
    blocks = counts.groupBy("block").agg(F.sum("documents").alias("d"), F.sum("tokens").alias("t"))
    later = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)  # one row per 1024 lengths
    blocks = blocks.select(
        "block",
        *(F.coalesce(F.sum(c).over(later), F.lit(0)).alias(f"{c}_after") for c in ("d", "t")),
        *(F.sum(c).over(W.partitionBy(F.lit(0))).alias(f"{c}_all") for c in ("d", "t")),
    )
    within = W.partitionBy("block").orderBy(F.desc("length"))
    sums = counts.join(blocks, "block").select(
        "length",
        "documents",
        "tokens",
        (F.sum("documents").over(within) + F.col("d_after")).alias("documents_at_least"),
        (F.sum("tokens").over(within) + F.col("t_after")).alias("tokens_at_least"),
        "d_all",
        "t_all",
    )
    longer = F.col("documents_at_least") - F.col("documents")
    return sums.select(
        "length",
        "documents",
        "tokens",
        "documents_at_least",
        "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("tokens") + longer * F.col("length")).alias("truncated_total"),
        (1 - longer / F.col("d_all")).alias("share_up_to"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """The tokens left when every document is cut to ``limit``, for any limit."""
    shorter = F.least("length", F.lit(limit))
    return histogram.agg(F.sum(shorter * F.col("documents"))).first()[0] or 0


def quantile(histogram: DataFrame, share: float) -> int | None:
    """The least length that at least ``share`` of the documents don't exceed."""
    return histogram.where(F.col("share_up_to") >= share).agg(F.min("length")).first()[0]

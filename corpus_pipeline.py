"""From raw documents to packed training sequences, in five stages over whole tables.

Each stage is a function of (spark, docs, sf_dir) to a DataFrame; the next one reads it back from Parquet. All but the
last return the columns of documents, and each works on all that its predecessor kept.
"""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import stored
from tradewind.llm.exact_dedup import exact_dedup
from tradewind.llm.packing import pack_documents
from tradewind.llm.quality import quality
from tradewind.llm.simhash import simhash_groups
from tradewind.llm.substring_dedup import cut_passages

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048


def _carried(docs: DataFrame) -> DataFrame:
    """Id and text beside the whole row, so that no other column's name meets an operator's own."""
    return docs.select("doc_id", "text", F.struct("*").alias("row"))


def accepted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality(_carried(docs)).where("accepted").select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup(_carried(docs), keep="largest").where("kept").select("row.*")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked, four bits apart at most, the one with the smallest id.

    Each row is judged by its own text, whatever its id. Null ids come last; of rows with one id any one may stay.
    """
    # A row's number comes from its text and id. Only where that names several rows, they are numbered in a copy.
    node = F.xxhash64(F.sha2(F.coalesce("text", F.lit("")), 256), "doc_id")
    rows = docs.select(F.struct("*").alias("row"), node.alias("node"))
    if not rows.groupBy("node").count().where("count > 1").isEmpty():
        rows = stored(rows.withColumn("node", F.monotonically_increasing_id()), "near-rows")
    named = rows.select("node", "row.doc_id", "row.text")
    groups = simhash_groups(named.drop("doc_id"), shingle=4, radius=4, id_col="node")
    groups = stored(groups.select(F.col("doc_id").alias("node"), F.col("component_id").alias("root")), "near-groups")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
    best = groups.join(named.drop("text"), "node").groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("n"))
    best = stored(best.where("n > 1").select("root", F.col("best.node").alias("stays")), "near-best")
    dropped = groups.join(best, "root").where("node <> stays")
    return rows.join(dropped, "node", "left_anti").select("row.*")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages of 50 words or more that an earlier document has; ``n_chars``, if there, follows the text."""
    cut = cut_passages(docs, least=50)
    if "n_chars" not in docs.columns:
        return cut
    n = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return cut.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of a document with its sequence of 2048 tokens and its place there, with its token ids."""
    return pack_documents(docs, tokenizer_path(TOKENIZER), CAPACITY, ids=True)


STAGES = [
    ("quality_classifier", accepted),
    ("exact_dedup", distinct_texts),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("best_fit_packing", packed),
]

# The classifier, the chains and the packing can't be said in SQL: tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each stored in the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

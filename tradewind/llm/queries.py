"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import bpe_tree, sentencepiece_codec
from tradewind.llm.centroids import clusters
from tradewind.llm.embedding_dedup import embedding_groups
from tradewind.llm.exact_dedup import exact_dedup
from tradewind.llm.length_histogram import length_histogram
from tradewind.llm.packing import pack_documents
from tradewind.llm.periodic_runs import periodic_runs
from tradewind.llm.quality import quality
from tradewind.llm.sharding import LAW, shard
from tradewind.llm.simhash import simhash_groups
from tradewind.llm.substring_dedup import repeated_passages
from tradewind.llm.token_blocks import read_tokens, write_tokens
from tradewind.sources.scratch import scratch_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    packed = pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path(WORD_BPE), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All passages of 50 words or more that documents repeat."""
    return repeated_passages(_table(spark, sf_dir, "documents"), least=50)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their fingerprints and near-duplicate groups."""
    return simhash_groups(_table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op4_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files, and read back."""
    path = scratch_path(spark, "token-files")
    write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE), path)
    return read_tokens(spark, path, ids=False)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of nearly equal bytes."""
    placed = shard(_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors with their near-duplicate groups."""
    return embedding_groups(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again: numbers of ids, checksums, and whether the text came back."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, tokenizer_path(PIECES))
    return coded.select("doc_id", "n_ids", "ids_crc32", F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of encoded lengths of all documents."""
    return length_histogram(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their quality and whether the classifier accepts them."""
    return quality(_table(spark, sf_dir, "documents")).select("doc_id", "quality_score", "accepted")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of equal texts."""
    found = exact_dedup(_table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by byte-level ranks and decoded again: numbers of ids, and digests of ids and bytes."""
    coded = bpe_tree.encode(_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_RANKS), PATTERN)
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return coded.select("doc_id", "n_tokens", *digests)


def _with_periods(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: about every tenth document with a word repeated over and over from some word on."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.when(F.col("code") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.select("doc_id", "text", code.alias("code")).withColumn("words", chosen)
    n, g = F.size("words"), F.floor(F.col("code") / 10)
    docs = docs.withColumns({"n": n, "g": g, "a": g % F.nullif(n, F.lit(0))})
    rest = F.col("n") - F.col("a")
    docs = docs.withColumns({"rest": rest, "period": 1 + F.floor(rest / (3 + F.col("g") % 8))})
    turn = F.slice("words", F.col("a").cast("int") + 1, F.col("period").cast("int"))
    turns = F.flatten(F.array_repeat(turn, F.ceil(F.col("rest") / F.col("period")).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(turns, F.lit(1), F.col("rest").cast("int")))
    text = F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their periodic runs: how many, the longest one, and digests of them and of what is left."""
    found = periodic_runs(_with_periods(_table(spark, sf_dir, "documents")), least=12)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    found = found.withColumns({"longest": longest, "n_runs": F.size("runs").cast("long")})
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("longest.col2")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.col3")).alias("period"),
        F.expr("1000 * longest.length div -longest.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in forty clusters, after five rounds."""
    return clusters(_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash": op3_simhash,
    "op4_token_blocks": op4_token_blocks,
    "op5_sharding": op5_sharding,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_centroids": op13_centroids,
}

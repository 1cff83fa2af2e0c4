"""Sharding by vector bin packing: bytes, tokens and rows are balanced together.

Rows with equal texts form a group. Groups are placed one after another, large ones first, each in the shard where the
dot product of its (bytes, tokens, rows) with the shard's residual capacity is highest. That loop runs over a bounded
number of items: small groups go into a fixed number of bundles by their digest, and only groups above a fixed share of
the whole are items of their own. The rows themselves stay in Spark.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import stored, text_or_empty

MEASURES = ["size", "tokens", "n"]
# What each measure counts in the dot product: the law is on bytes.
WEIGHTS = np.array([4.0, 1.0, 1.0])
LAW = "bytes"
# A token, about: a word between white space, or one letter of the scripts that are written without spaces.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+"


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item. ``items`` has one row of measures each, as shares of the whole."""
    need = items * shards
    room = np.ones((shards, items.shape[1]))
    out = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-need.max(axis=1), kind="stable"):
        out[i] = s = int(np.argmax(room @ (WEIGHTS * need[i])))
        room[s] -= need[i]
    return out


def shard(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    bundles: int = 8192,
    own_items: int = 2048,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``size`` (bytes of the text plus 1), ``text_crc32``, ``shard`` and ``slot``.

    Tokens are words between white space, and single letters of scripts without spaces; one more for the end. The law is ``bytes``: shards get nearly equal sizes. Equal texts stay together
    unless their group is more than a whole shard of any measure; such a group is split evenly by id. A group is an item
    of its own from 1 / ``own_items`` of the whole on, so there are at most three times that many. Slots count the rows
    of a shard from 0 without gaps. A null text is an empty one, ids may be null or repeat, and every row has its own
    slot. An empty table gives an empty result; other columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    text = text_or_empty(docs[text_col])
    rows = docs.select(
        docs[id_col].alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        (F.regexp_count(text, F.lit(TOKEN)) + 1).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = stored(rows, "shard-rows")
    groups = rows.groupBy("sha").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    total = rows.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")).first()
    whole = [max(1, total[m] or 0) for m in MEASURES]
    share = F.greatest(*(F.col(m) / F.lit(float(t)) for m, t in zip(MEASURES, whole, strict=True)))
    large = groups.select("sha", share.alias("share"), "n").where(F.col("share") >= 1 / own_items)
    found = sorted((bytes(r.sha), r.share, r.n) for r in large.collect())  # at most 3 * own_items
    # A cell is a part of an item that one task numbers: about as many rows as a bundle.
    cell_rows = max(1, whole[2] // bundles)
    named = [
        (sha, bundles + i, -(-int(s * shards * 4) // 1) if s * shards > 1 else 1, -(-n // cell_rows))
        for i, (sha, s, n) in enumerate(found)
    ]
    own = spark.createDataFrame(named, "sha binary, item long, parts long, cells long")
    # The parts of a group are items of their own: item, part, cell.
    mixed = F.xxhash64("id", F.lit("cell"))
    cells = (
        rows.join(F.broadcast(own), "sha", "left")
        .withColumn("item", F.coalesce("item", F.pmod(F.xxhash64("sha"), F.lit(bundles))))
        .withColumn("cell", F.pmod(mixed, F.coalesce("cells", F.lit(1))))
        .withColumn("part", F.pmod("cell", F.coalesce("parts", F.lit(1))))
        .select("id", "size", "tokens", "text_crc32", "item", "part", "cell")
    )
    known = (
        cells.groupBy("item", "part", "cell")
        .agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
        .orderBy("item", "part", "cell")
        .collect()  # at most 2 * bundles + 3 * own_items cells
    )
    wanted: dict[tuple, np.ndarray] = {}
    for r in known:
        v = np.array([r[m] / t for m, t in zip(MEASURES, whole, strict=True)])
        wanted[r.item, r.part] = wanted.get((r.item, r.part), 0) + v
    at = dict(zip(wanted, place(np.array(list(wanted.values())).reshape(-1, 3), shards), strict=True))
    filled, placed = [0] * shards, []
    for r in known:
        s = int(at[r.item, r.part])
        placed.append((r.item, r.cell, s, filled[s]))
        filled[s] += r.n
    where = spark.createDataFrame(placed, "item long, cell long, shard int, first long")
    rank = F.row_number().over(W.partitionBy("item", "cell").orderBy("id", "text_crc32"))
    return cells.join(F.broadcast(where), ["item", "cell"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("first") + rank - 1).alias("slot")
    )

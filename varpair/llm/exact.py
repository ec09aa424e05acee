"""Exact deduplication by a distributed content sort (DataFrame functions only).

Normalised texts are dealt out by range: Spark samples splitters of the sort
key, each range is sorted externally, and a window over the sorted rows compares
whole neighbouring texts.  The splitters hold a short head of the text and its
hash, so they stay small however long the texts are.  A text with very many
copies would fill one range: its rows get a salt, are sorted apart in several
ranges, and the few rows that lead there are compared once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .io import NO_ID, ascii_lower, real_id, saved

#: Characters of the text in a splitter; copies beyond which a text is salted; salts; most texts salted.
HEAD_CHARS, HOT_COPIES, SALTS, MAX_HOT = 32, 512, 32, 1024


def _runs(rows: DataFrame) -> DataFrame:
    """Sort by content; each row with the largest id, the size and its rank in its run of equal texts."""
    key = ["_head", "_hash", "_salt"]
    dealt = rows.withColumn("_head", F.substring("_norm", 1, HEAD_CHARS)).repartitionByRange(*key)
    same = Window.partitionBy(*key, "_norm").orderBy(F.col("_id").desc())
    return dealt.select(
        "_id",
        "_hash",
        "_salt",
        "_norm",
        F.sha2("_norm", 256).alias("_sha"),
        F.first("_id").over(same).alias("_keep"),
        F.count("*").over(same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_n"),
        F.row_number().over(same).alias("_rank"),
    )


def exact_duplicates(docs: DataFrame, hot_copies: int = HOT_COPIES, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.
    The row with the largest doc_id of a group stays (a null doc_id counts as
    the largest); of rows that repeat that doc_id exactly one stays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), ascii_lower(text).alias("_norm")).withColumn("_hash", F.xxhash64("_norm"))
    counts = rows.groupBy("_hash").agg(F.count("*").alias("n")).filter(F.col("n") > hot_copies)
    hot = [r["_hash"] for r in counts.orderBy(F.desc("n"), "_hash").limit(MAX_HOT).collect()]

    salt = F.when(F.col("_hash").isin(hot), F.pmod(F.xxhash64("_id"), F.lit(salts))) if hot else F.lit(None).cast("long")
    runs = _runs(rows.withColumn("_salt", F.coalesce(salt, F.lit(-1))))
    runs = runs.withColumn("_text", F.when((F.col("_salt") >= 0) & (F.col("_rank") == 1), F.col("_norm"))).drop("_norm")
    if not hot:
        result = runs
    else:
        parts = saved(runs, "exact-runs")
        whole = Window.partitionBy("_text")
        # at most MAX_HOT texts with `salts` heads each
        lead = parts.filter(F.col("_text").isNotNull()).select("_hash", F.col("_keep").alias("_local"), F.max("_keep").over(whole).alias("_lead"), F.sum("_n").over(whole).alias("_all"))
        lead = lead.groupBy("_hash", "_local").agg(F.max("_lead").alias("_lead"), F.max("_all").alias("_all"))
        split = parts.filter(F.col("_salt") >= 0).withColumnRenamed("_keep", "_local").join(lead, ["_hash", "_local"])
        split = split.select("_id", F.col("_lead").alias("_keep"), F.col("_all").alias("_n"), F.when(F.col("_id") == F.col("_lead"), F.col("_rank")).otherwise(F.lit(0)).alias("_rank"), "_sha")
        result = parts.filter(F.col("_salt") < 0).select("_id", "_keep", "_n", "_rank", "_sha").unionByName(split)
    result = result.select("_id", "_keep", "_n", (F.col("_rank") == 1).alias("kept"), F.col("_sha").alias("text_sha256"))
    return result.select(real_id("_id").alias("doc_id"), real_id("_keep").alias("keep_id"), F.col("_n").cast("long").alias("group_size"), "kept", "text_sha256")

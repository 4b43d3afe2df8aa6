"""Operator 1: exact deduplication with a heavy-hitter split (DataFrame functions only).

Texts are equal when identical after every run of ASCII white space becomes one
space.  A Misra-Gries summary (Spark's mergeable frequent-items sketch, merged in
two levels so that no task reads more than about the square root of all partial
summaries) names the digests that may be frequent.  Their exact counts and
winners are computed with map-side combining, and only those with two or more
rows ("verified") are broadcast: at most ``max_items`` rows of about 60 bytes.
Rows with such a digest are settled where they lie; every other digest occurs in
at most about ``3.5 / max_items`` of the rows and goes through an ordinary shuffle.

Defined results: null text counts as empty; the row with the smallest id stays,
null ids come last; of rows with equal id and equal text one stays; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, col, keep_rows, saved, text_hash

MAX_ITEMS = 8192


def normalised(text_col: str):
    return F.regexp_replace(F.coalesce(col(text_col).cast("string"), F.lit("")), WS, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                max_items: int = MAX_ITEMS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256, text_hash.

    ``text_hash`` is the 64-bit hash of the text as given (row identity for joins).
    """
    rows = saved(docs.select(
        col(id_col).alias("id"), text_hash(text_col).alias("text_hash"),
        F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("rid")), "digests")
    order = F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("rid"))

    # Misra-Gries summaries on an 8-byte hash of the digest, merged in two levels
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    item = F.xxhash64("digest")
    level1 = (rows.select(item.alias("item"), (F.spark_partition_id() % groups).alias("g"))
              .groupBy("g").agg(F.expr(f"approx_top_k_accumulate(item, {max_items})").alias("s")))
    # grouped by a constant: a task without rows then adds no (empty) summary
    frequent = (level1.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(s, {max_items})").alias("s"))
                .select(F.explode(F.expr(f"approx_top_k_estimate(s, {max_items})")).alias("e"))
                .where("e.count >= 2").select(F.col("e.item").alias("item")))

    winners = saved(
        rows.join(F.broadcast(frequent), F.xxhash64("digest") == frequent["item"], "left_semi")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("best"))
        .where("group_size >= 2").coalesce(1), "winners")

    w = Window.partitionBy("digest")
    light = (rows.join(F.broadcast(winners), "digest", "left_anti")
             .withColumn("group_size", F.count(F.lit(1)).over(w))
             .withColumn("best", F.min(order).over(w)))
    heavy = rows.join(F.broadcast(winners), "digest")
    cols = ["id", "text_hash", "digest", "rid", "group_size", "best"]
    return (heavy.select(cols).unionByName(light.select(cols))
            .select("id", F.col("best.id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("best.rid")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256"), "text_hash"))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col("id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    return keep_rows(docs, kept, id_col, text_col, once=True)

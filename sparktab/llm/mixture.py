"""Operator 6: mixing sources to target weights by capped water-filling.

Every source gets a share of the total in proportion to its weight, clamped at
``max_epochs`` times its own size; what the clamp cuts off is shared out again by
weight until no source is above its cap.  With the sources sorted by cap / weight
the clamped ones form a prefix, so prefix sums over the (small) table of sources
give the fixed point directly.

A source's documents are taken ``floor(target / size)`` whole times; the rest of
the target is filled, in the order of a seeded hash of the id, by one more
repetition of a document as long as at least half of it fits.  That cut is found
without sorting a source: sizes are summed per (source, hash bucket) with
map-side combining, and only the one bucket that holds the cut is put in order.

Defined results: a null text has size 0; null is a source of its own, last in
order; sources of size 0 get target 0; rows with equal source and id are taken
or left together; an empty table gives an empty result; other columns pass through
``mix_documents`` and are not read by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.hashing import hash_u32, sql_hash_u32

from .common import NOT_WS, col, saved

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
BUCKETS = 4096
SHIFT = 20  # 32-bit hash to one of BUCKETS


def size_of(text_col: str):
    return F.coalesce(F.regexp_count(col(text_col).cast("string"), F.lit(NOT_WS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source (columns ``source``, ``source_size``) its target; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.array(*[F.lit(w) for w in weights])
    t = sizes.withColumn("k", F.row_number().over(by_name) - 1)
    t = t.withColumn("w", F.element_at(pick, (F.col("k") % len(weights) + 1).cast("int")).cast("long"))
    t = t.withColumn("cap", F.col("source_size") * max_epochs)
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("k"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = t.withColumn("level", (F.sum("source_size").over(everything)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double")
                     / F.sum("w").over(after))
    t = t.withColumn("free", F.col("level") * F.col("w") <= F.col("cap"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.withColumn("level", F.first(F.when(F.col("free"), F.col("level")), True).over(whole))
    target = F.when(F.col("free"), F.col("level") * F.col("w")).otherwise(F.col("cap").cast("double"))
    return t.select("source", "source_size", target.alias("target"))


def _plan(rows: DataFrame, weights, max_epochs) -> DataFrame:
    """Per source: target, whole repetitions and the (hash, id) up to which one more is taken."""
    per_bucket = (rows.groupBy("source", F.shiftright("h", SHIFT).alias("b"))
                  .agg(F.sum("size").alias("bucket_size")))
    per_bucket = saved(per_bucket, "mix-buckets")  # at most sources x BUCKETS rows
    t = targets(per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = t.withColumn("whole", F.floor(rate))
    t = saved(t.withColumn("quota", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    up_to = Window.partitionBy("source").orderBy("b")
    b = per_bucket.withColumn("cum", F.sum("bucket_size").over(up_to))
    t2 = t.select(F.col("source").alias("s"), "quota")
    cut = (b.join(t2, b["source"].eqNullSafe(t2["s"])).where("cum >= quota and quota > 0")
           .groupBy("source").agg(F.min(F.struct("b", (F.col("cum") - F.col("bucket_size")).alias("base"))).alias("c"))
           .select(F.col("source").alias("s"), F.col("c.b").alias("cut_b"), F.col("c.base").alias("base")))
    t = t.join(cut, t["source"].eqNullSafe(cut["s"]), "left").drop("s")
    # the bucket that holds the cut, in order
    e = t.select(F.col("source").alias("s"), "cut_b", "base", "quota").where("cut_b is not null")
    edge = (rows.join(e, rows["source"].eqNullSafe(e["s"]) & (F.shiftright("h", SHIFT) == e["cut_b"]))
            .groupBy("source", "h", "id", "base", "quota").agg(F.sum("size").alias("unit")))
    order = Window.partitionBy("source").orderBy("h", F.col("id").asc_nulls_last())
    edge = edge.withColumn("cum", F.sum("unit").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.where("base + cum - unit + unit / 2.0D <= quota")
    last = edge.groupBy("source").agg(F.max(F.struct("h", F.col("id").isNull().alias("n"), "id")).alias("last"))
    last = last.select(F.col("source").alias("s"), "last")
    t = t.join(last, t["source"].eqNullSafe(last["s"]), "left").drop("s")
    return saved(t.select(F.col("source").alias("s"), "source_size", "target", "whole", "cut_b", "last"), "mix-plan")


def _repetitions():
    """Repetitions of a row with ``h`` and ``id`` under its source's plan."""
    b = F.shiftright("h", SHIFT)
    more = F.when(F.col("cut_b").isNull(), False).when(b != F.col("cut_b"), b < F.col("cut_b")).otherwise(
        F.coalesce(F.struct("h", F.col("id").isNull().alias("n"), "id") <= F.col("last"), F.lit(False)))
    return F.col("whole") + more.cast("long")


def _rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    out = docs.select(col(id_col).alias("id"), col(source_col).cast("string").alias("source"),
                      size_of(text_col).alias("size"))
    return out.withColumn("h", hash_u32(["id"], seed))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, repetitions, taken."""
    rows = saved(_rows(docs, id_col, text_col, source_col, seed), "mix-rows")
    plan = _plan(rows, weights, max_epochs)
    out = rows.join(plan, rows["source"].eqNullSafe(plan["s"]))
    out = out.withColumn("repetitions", _repetitions())
    return out.select("id", "size", "source_size", "target", "repetitions",
                      (F.col("size") * F.col("repetitions")).alias("taken"))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all their columns."""
    rows = saved(_rows(docs, id_col, text_col, source_col, seed), "mix-rows")
    plan = _plan(rows, weights, max_epochs)
    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("r_"), col(id_col).alias("id"),
                         col(source_col).cast("string").alias("source"))
    packed = packed.withColumn("h", hash_u32(["id"], seed))
    out = packed.join(plan, packed["source"].eqNullSafe(plan["s"])).withColumn("repetitions", _repetitions())
    times = F.array_repeat(F.lit(0), F.col("repetitions").cast("int"))
    return out.select("r_", F.explode(times).alias("i_")).select("r_.*")


def mix_sql(weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED,
            documents: str = "documents") -> str:
    """DuckDB SQL for ``mix`` over a table of documents."""
    pick = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{NOT_WS}')), 0) AS BIGINT) AS size,
         {sql_hash_u32(['doc_id'], seed)} AS h FROM {documents}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k, source_size * {max_epochs} AS cap FROM s),
w AS (SELECT *, CASE k % {len(weights)} {pick} END AS w FROM k),
l AS (
  SELECT *, CAST((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER (
      ORDER BY CAST(cap AS DOUBLE) / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / CAST(sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
             AS DOUBLE) AS level FROM w),
f AS (SELECT *, level * w <= cap AS free FROM l),
t AS (
  SELECT source, source_size, CASE WHEN free THEN (
      SELECT level FROM f WHERE free ORDER BY CAST(cap AS DOUBLE) / w, k LIMIT 1) * w
    ELSE CAST(cap AS DOUBLE) END AS target FROM f),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
q AS (SELECT *, target - whole * source_size AS quota FROM r),
u AS (SELECT source, h, doc_id, sum(size) AS unit FROM d GROUP BY ALL),
c AS (SELECT source, h, doc_id, unit, sum(unit) OVER (
        PARTITION BY source ORDER BY h, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING) AS cum FROM u)
SELECT d.doc_id, d.size, q.source_size, q.target,
       CAST(d.size * (q.whole + CASE WHEN q.quota > 0 AND c.cum - c.unit + c.unit / 2.0 <= q.quota
                                THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h = c.h AND d.doc_id IS NOT DISTINCT FROM c.doc_id"""

"""Drift statistics between a reference and a current slice (X3 PSI, X4 KS).

Both are computed for many features at once over a long ``(feature, value,
side)`` view, with conditional counts instead of joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .quantiles import quantiles

PSI_EPS = 1e-6
MAX_KS_DISTINCT = 5_000_000


def _long(df: DataFrame, cols: Sequence[str], is_ref: Column) -> DataFrame:
    sel = df.select(is_ref.alias("_ref"), *[F.col(c).cast("double").alias(c) for c in cols])
    return sel.unpivot(["_ref"], list(cols), "feature", "value").where(F.col("value").isNotNull())


def psi(df: DataFrame, cols: Sequence[str], is_ref: Column, bins: int = 10) -> DataFrame:
    """Population stability index per feature over reference-decile bins.

    ``bin(v)`` = number of reference quantile edges strictly below ``v``; empty
    shares are floored at ``1e-6``; ``psi = sum (cur - ref) * ln(cur / ref)``.
    """
    long = _long(df, cols, is_ref)
    probs = [i / bins for i in range(1, bins)]
    edges = {r["feature"]: r["q"] for r in
             quantiles(long.where("_ref"), "value", probs, by=["feature"]).collect()}
    bin_expr = F.lit(0)
    for c in cols:
        e = edges.get(c) or []
        b = F.lit(0)
        for x in e:
            b = b + F.when(F.col("value") > F.lit(float(x)), 1).otherwise(0)
        bin_expr = F.when(F.col("feature") == F.lit(c), b).otherwise(bin_expr)
    counts = (long.groupBy("feature", bin_expr.alias("bin"))
              .agg(F.count(F.when(F.col("_ref"), 1)).alias("n_ref"),
                   F.count(F.when(~F.col("_ref"), 1)).alias("n_cur")))
    tot = Window.partitionBy("feature")
    # an empty side gives null shares (try_divide), floored to eps like empty bins
    shares = (counts.withColumn("p", F.greatest(F.try_divide(F.col("n_ref"), F.sum("n_ref").over(tot)),
                                                F.lit(PSI_EPS)))
              .withColumn("q", F.greatest(F.try_divide(F.col("n_cur"), F.sum("n_cur").over(tot)),
                                          F.lit(PSI_EPS))))
    return shares.groupBy("feature").agg(
        F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"),
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))


def ks(df: DataFrame, cols: Sequence[str], is_ref: Column,
       max_distinct: int = MAX_KS_DISTINCT) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic ``max |F_ref - F_cur|`` per feature.

    Rows are first reduced to ``(feature, value)`` counts.  Below
    ``max_distinct`` distinct values per feature a running-sum window over those
    counts does the rest; above it the exact range-partitioned path runs
    (``_ks_ranged``), so no feature is ever gathered in one task.
    """
    long = _long(df, cols, is_ref)
    counts = (long.groupBy("feature", "value")
              .agg(F.count(F.when(F.col("_ref"), 1)).alias("a"), F.count(F.when(~F.col("_ref"), 1)).alias("b")))
    widest = long.groupBy("feature").agg(F.approx_count_distinct("value").alias("d")).agg(F.max("d")).first()[0]
    if widest and widest > max_distinct:
        return _ks_ranged(counts)
    w = Window.partitionBy("feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    tot = Window.partitionBy("feature")
    cdf = (counts.withColumn("fa", F.try_divide(F.sum("a").over(w), F.sum("a").over(tot)))  # empty side: null
           .withColumn("fb", F.try_divide(F.sum("b").over(w), F.sum("b").over(tot)))
           .withColumn("na", F.sum("a").over(tot)).withColumn("nb", F.sum("b").over(tot)))
    return cdf.groupBy("feature").agg(F.max(F.abs(F.col("fa") - F.col("fb"))).alias("ks"),
                                      F.first("na").alias("n_ref"), F.first("nb").alias("n_cur"))


def _ks_ranged(counts: DataFrame, partitions: int | None = None) -> DataFrame:
    """Exact KS over range-partitioned ``(feature, value, a, b)`` counts.

    The counts are written once with the number of their range, so ranges cannot move.
    A running sum over the small table of range totals gives every range its offset;
    inside a range a window adds up the rest.  An empty side gives a null statistic.
    """
    spark = counts.sparkSession
    n = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    path = scratch_path(spark, "ks-ranges")
    (counts.repartitionByRange(n, "feature", "value").withColumn("pid", F.spark_partition_id())
     .write.parquet(path))
    ranged = spark.read.parquet(path)
    total = ranged.groupBy("feature", "pid").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    before = Window.partitionBy("feature").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    off = total.select("feature", "pid", F.coalesce(F.sum("ta").over(before), F.lit(0)).alias("oa"),
                       F.coalesce(F.sum("tb").over(before), F.lit(0)).alias("ob"),
                       F.sum("ta").over(whole).alias("na"), F.sum("tb").over(whole).alias("nb"))
    w = Window.partitionBy("feature", "pid").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cum = (ranged.withColumn("ca", F.sum("a").over(w)).withColumn("cb", F.sum("b").over(w))
           .join(off, ["feature", "pid"]))  # one row per feature and range: Spark picks the join
    gap = F.abs(F.try_divide(F.col("oa") + F.col("ca"), F.col("na")) - F.try_divide(F.col("ob") + F.col("cb"), F.col("nb")))
    return cum.groupBy("feature").agg(F.max(gap).alias("ks"), F.first("na").alias("n_ref"), F.first("nb").alias("n_cur"))

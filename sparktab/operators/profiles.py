"""Drift over time (X3, X4): a stored reference profile against which later windows are compared.

``build`` reads the reference once and keeps, per feature, the quantile edges and the number of
values between them.  The profile is one narrow row per feature: it is stored as a table, profiles
with the same edges merge by adding counts, and any number of windows are compared
with it in one aggregate over the current rows, without reading the reference again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .drift import PSI_EPS
from .quantiles import quantiles

SCHEMA = "feature string, edges array<double>, counts array<bigint>, n bigint"
MAX_BROADCAST_FEATURES = 100_000  # so many profile rows are broadcast; more are joined


def _long(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    sel = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return sel.unpivot(list(keep), list(cols), "feature", "value").where(F.col("value").isNotNull())


def _bin(edges: str = "edges") -> Column:
    """Number of edges strictly below the value."""
    return F.size(F.filter(edges, lambda e: e < F.col("value")))


def _few(profile: DataFrame) -> DataFrame:
    few = profile.limit(MAX_BROADCAST_FEATURES + 1).count() <= MAX_BROADCAST_FEATURES
    return F.broadcast(profile) if few else profile


def count(df: DataFrame, cols: Sequence[str], edges: DataFrame) -> DataFrame:
    """A profile of ``df`` over given edges (feature, edges)."""
    binned = _long(df, cols).join(_few(edges.select("feature", "edges")), "feature")
    n = binned.groupBy("feature", _bin().alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    n = n.groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "k"))).alias("m"))  # one entry per bin
    out = edges.select("feature", "edges").join(n, "feature", "left")
    counts = F.transform(F.sequence(F.lit(0), F.size("edges")), lambda b: F.coalesce(F.try_element_at("m", b), F.lit(0)))
    out = out.withColumn("counts", counts.cast("array<bigint>"))
    return out.select("feature", "edges", "counts", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))


def build(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """The profile of a reference: exact quantile edges and counts (one row per feature)."""
    edges = quantiles(_long(df, cols), "value", [i / bins for i in range(1, bins)], by=["feature"])
    return count(df, cols, edges.select("feature", F.col("q").alias("edges")))


def merge(*profiles: DataFrame) -> DataFrame:
    """Profiles over the same edges as one; a feature whose edges differ raises an error when it is read."""
    whole = profiles[0]
    for p in profiles[1:]:
        whole = whole.unionByName(p)
    add = F.expr("aggregate(all, transform(edges, x -> cast(0 as bigint)) || array(cast(0 as bigint)), "
                 "(a, c) -> zip_with(a, c, (x, y) -> x + y))")
    out = whole.groupBy("feature").agg(F.min("edges").alias("edges"), F.max("edges").alias("other"),
                                       F.collect_list("counts").alias("all"), F.sum("n").alias("n"))  # one per profile
    same = F.when(F.col("edges") == F.col("other"), F.col("edges")).otherwise(
        F.raise_error(F.concat(F.lit("profiles have different edges for "), "feature")).cast("array<double>"))
    return out.select("feature", same.alias("edges"), add.alias("counts"), "n")


def compare(df: DataFrame, cols: Sequence[str], profile: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by..., feature, psi, ks, n_ref, n_cur) of every window of ``df`` against the stored profile.

    ``psi`` over the profile's bins as in ``drift.psi``; ``ks`` is the largest gap between the two
    distribution functions at the edges, so never above the exact statistic.
    """
    profile = _few(profile.select("feature", F.col("edges").alias("_edges"), F.col("counts").alias("_counts"), F.col("n").alias("_n")))
    rows = _long(df, cols, by).join(profile.select("feature", "_edges"), "feature")
    cur = rows.groupBy(*by, "feature", _bin("_edges").alias("_bin")).agg(F.count(F.lit(1)).alias("_k"))
    windows = cur.groupBy(*by, "feature").agg(F.map_from_entries(F.collect_list(F.struct("_bin", "_k"))).alias("_m"),
                                              F.sum("_k").alias("n_cur"))  # one entry per bin
    both = windows.join(profile, "feature")
    both = both.select(*by, "feature", F.col("_n").alias("n_ref"), "n_cur", F.posexplode(F.transform(
        "_counts", lambda c, i: F.struct(c.alias("r"), F.coalesce(F.try_element_at("_m", i), F.lit(0)).alias("c")))).alias("_bin", "_x"))
    p, q = F.try_divide("_x.r", "n_ref"), F.try_divide("_x.c", "n_cur")
    fp, fq = F.greatest(p, F.lit(PSI_EPS)), F.greatest(q, F.lit(PSI_EPS))
    w = Window.partitionBy(*by, "feature").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(F.try_divide(F.sum("_x.r").over(w), "n_ref") - F.try_divide(F.sum("_x.c").over(w), "n_cur"))
    both = both.withColumns({"_part": (fq - fp) * F.log(fq / fp), "_gap": gap})
    return both.groupBy(*by, "feature").agg(F.sum("_part").alias("psi"), F.max("_gap").alias("ks"),
                                            F.first("n_ref").alias("n_ref"), F.first("n_cur").alias("n_cur"))

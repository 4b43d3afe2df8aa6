"""Exact order statistics at any scale, with bounded memory per task.

Quantiles use linear interpolation between the values at ranks
``floor(p (n-1))`` and ``ceil(p (n-1))`` (the reference's default, Spark's
``percentile`` and DuckDB's ``quantile_cont``).  Two exact strategies:

* **frequency path** (few distinct values per group): ``(group, value, count)``
  pre-aggregates feed ``percentile(v, p, freq)``.  A hot value collapses to one
  row per task before the shuffle; the final buffer holds one entry per
  distinct value, so this path is taken only below a checked distinct count.
* **bracket path** (many distinct values): a ``percentile_approx`` sketch
  brackets each target rank (rank error at most ``n / accuracy``), one pass
  counts the rows below each bracket and pre-aggregates the ``(value, count)``
  pairs inside it, and a window over those bounded pairs picks the exact ranks.
  A bracket that misses (possible only through ties or sketch error) is
  widened and retried.  No task ever holds a whole group.

``exact="auto"`` picks the path from an ``approx_count_distinct`` check;
``True`` forces the frequency path, ``"bracket"`` the bracket path, and
``False`` returns the sketch values directly (approximate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import local_table, scratch_path

MAX_EXACT_DISTINCT = 2_000_000
APPROX_ACCURACY = 100_000
MAX_GROUPS = 100_000


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              exact: bool | str = "auto", out: str = "q",
              max_distinct: int = MAX_EXACT_DISTINCT, accuracy: int = APPROX_ACCURACY) -> DataFrame:
    """``(by..., q array<double>)`` with ``q[i]`` the ``probs[i]`` quantile of ``value``."""
    v = F.col(value).cast("double")
    probs_col = F.array(*[F.lit(float(p)) for p in probs])
    if exact is False:
        agg = F.percentile_approx(v, probs_col, accuracy)
        return df.groupBy(*by).agg(agg.alias(out)) if by else df.agg(agg.alias(out))
    if exact == "bracket":
        return bracket_quantiles(df, value, probs, by, out=out, accuracy=accuracy)
    if exact == "auto":
        if by:
            widest = df.groupBy(*by).agg(F.approx_count_distinct(v).alias("d")).agg(F.max("d")).first()[0]
        else:
            widest = df.agg(F.approx_count_distinct(v)).first()[0]
        few = (widest or 0) <= max_distinct
    else:
        few = True
    if few:
        freq = (df.where(v.isNotNull()).groupBy(*by, v.alias("_v"))
                .agg(F.count(F.lit(1)).alias("_f")))
        agg = F.percentile(F.col("_v"), probs_col, F.col("_f"))
        return freq.groupBy(*by).agg(agg.alias(out)) if by else freq.agg(agg.alias(out))
    return bracket_quantiles(df, value, probs, by, out=out, accuracy=accuracy)


def bracket_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
                      out: str = "q", accuracy: int = APPROX_ACCURACY, max_tries: int = 4) -> DataFrame:
    """Exact quantiles by sketch brackets (see module doc); null groups are groups like any other.

    A row is only multiplied by the brackets that it lies in, which is about
    ``n / accuracy`` of the rows for each; what lies below is counted per bracket in one wide aggregate.
    """
    spark = df.sparkSession
    groups = [f"_g{i}" for i in range(len(by))]
    base = df.where(F.col(value).isNotNull()).select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)], F.col(value).cast("double").alias("_v"))
    js, margin = range(len(probs)), 2.0 / accuracy
    for _ in range(max_tries):
        lo_p = [max(0.0, p - margin) for p in probs]
        hi_p = [min(1.0, p + margin) for p in probs]
        sketch = base.groupBy(*groups).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_v", F.array(*[F.lit(x) for x in lo_p + hi_p]), accuracy).alias("_b"))
        wide = []
        for j, p in enumerate(probs):
            pos = F.lit(float(p)) * (F.col("_n") - 1)
            wide += [F.col("_b")[j].alias(f"_lo{j}"), F.col("_b")[len(probs) + j].alias(f"_hi{j}"),
                     pos.alias(f"_pos{j}")]
        brk = sketch.where("_n > 0").select(*[F.col(g).alias(f"_r{g}") for g in groups], *wide)
        rows = brk.limit(MAX_GROUPS + 1).collect()
        few = len(rows) <= MAX_GROUPS
        if few:
            brk = local_table(spark, [tuple(r) for r in rows], brk.schema)
        else:  # one narrow row per group, written once
            path = scratch_path(spark, "brackets")
            brk.write.parquet(path)
            brk = spark.read.parquet(path)
        if not by:
            if not rows:
                return spark.createDataFrame([(None,)], f"{out} array<double>")
            one = rows[0].asDict()
            joined = base.withColumns({c: F.lit(v) for c, v in one.items()})
        else:
            on = [F.col(g).eqNullSafe(F.col(f"_r{g}")) for g in groups]
            cond = on[0]
            for c in on[1:]:
                cond = cond & c
            joined = base.join(F.broadcast(brk) if few else brk, cond)
        below = joined.groupBy(*groups).agg(*[
            F.count(F.when(F.col("_v") < F.col(f"_lo{j}"), 1)).alias(f"_below{j}") for j in js],
            *[F.first(f"_pos{j}").alias(f"_pos{j}") for j in js])
        near = F.filter(F.array(*[F.when((F.col("_v") >= F.col(f"_lo{j}")) & (F.col("_v") <= F.col(f"_hi{j}")),
                                         F.lit(j)) for j in js]), lambda x: x.isNotNull())
        inside = (joined.select(*groups, "_v", F.explode(near).alias("_j"))
                  .groupBy(*groups, "_j", "_v").agg(F.count(F.lit(1)).alias("_c")))
        w = Window.partitionBy(*groups, "_j").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
        inside = inside.withColumn("_end", F.sum("_c").over(w))
        below = below.select(*[F.col(g).alias(f"_s{g}") for g in groups], F.explode(F.array(*[
            F.struct(F.lit(j).alias("k"), F.col(f"_below{j}").alias("below"), F.col(f"_pos{j}").alias("pos"))
            for j in js])).alias("_t"))
        cond = F.col("_j") == F.col("_t.k")
        for g in groups:
            cond = cond & F.col(g).eqNullSafe(F.col(f"_s{g}"))
        cum = below.join(inside, cond, "left").withColumn("_end", F.col("_t.below") + F.col("_end"))
        # value at 0-based rank k: the row whose [start, end) covers k
        def at(k):
            return F.min(F.when((F.col("_end") - F.col("_c") <= k) & (k < F.col("_end")), F.col("_v")))
        keys = [f"_s{g}" for g in groups]
        picked = cum.groupBy(*keys, F.col("_t.k").alias("_k"), F.col("_t.pos").alias("_pos")).agg(
            at(F.floor("_t.pos")).alias("_vlo"), at(F.ceil("_t.pos")).alias("_vhi"))
        lo, hi = F.floor("_pos"), F.ceil("_pos")
        q = F.when(lo == hi, F.col("_vlo")).otherwise(
            (hi - F.col("_pos")) * F.col("_vlo") + (F.col("_pos") - lo) * F.col("_vhi"))
        found = picked.groupBy(*keys).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_k", q.alias("q")))), lambda x: x["q"]).alias(out),
            F.count(F.when(F.col("_vlo").isNull() | F.col("_vhi").isNull(), 1)).alias("_open"))
        path = scratch_path(spark, "quantiles")  # one row per group, read more than once
        found.write.parquet(path)
        found = spark.read.schema(found.schema).parquet(path)
        if found.where("_open > 0").isEmpty():
            return found.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], out)
        margin *= 16
    raise RuntimeError("quantile brackets did not converge")

"""Dataset profiling (R3-R14): the numbers behind the reference's summaries and plots.

Each function is one or two aggregates; only scalars that parameterise a
later expression (min/max, bandwidth, group fences) are read on the driver,
and those are bounded by the number of columns or groups.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_table
from .quantiles import MAX_EXACT_DISTINCT, quantiles

MAX_GROUPS = 100_000  # per-group statistics are broadcast back; bound them

_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8}


def dataset_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and an in-memory size estimate in MiB (3 decimals).

    Size = fixed width x rows for fixed-width columns + UTF-8 bytes of strings.
    (Re-aimed: Python object overhead has no Spark meaning.)
    """
    fixed = sum(w for f in df.schema.fields for t, w in _WIDTH.items() if isinstance(f.dataType, t))
    var = [F.coalesce(F.sum(F.octet_length(F.col(f.name))), F.lit(0)) for f in df.schema.fields
           if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    n = F.count(F.lit(1))
    size = n * F.lit(fixed)
    for v in var:
        size = size + v
    return df.agg(n.alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
                  F.round(size / F.lit(1024.0 ** 2), 3).alias("memory_mb"))


def summary_and_nulls(df: DataFrame) -> tuple[dict, dict[str, int]]:
    """R3/R4/R5 in one pass: the summary row and every column's null count (bounded by columns)."""
    fixed = sum(w for f in df.schema.fields for t, w in _WIDTH.items() if isinstance(f.dataType, t))
    var = [F.coalesce(F.sum(F.octet_length(F.col(f.name))), F.lit(0)) for f in df.schema.fields
           if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    n = F.count(F.lit(1))
    size = n * F.lit(fixed)
    for v in var:
        size = size + v
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"_null_{i}") for i, c in enumerate(df.columns)]
    r = df.agg(n.alias("n_rows"), F.round(size / F.lit(1024.0 ** 2), 3).alias("memory_mb"), *nulls).first()
    summary = {"n_rows": r["n_rows"], "n_columns": len(df.columns), "memory_mb": r["memory_mb"]}
    return summary, {c: int(r[f"_null_{i}"]) for i, c in enumerate(df.columns)}


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, nulls)`` from one aggregate over every column."""
    wide = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "nulls")


def info(df: DataFrame) -> DataFrame:
    """``(position, column_name, dtype, non_null)``."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column_name", "non_null")
    meta = local_table(df.sparkSession, 
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column_name string, dtype string")
    return F.broadcast(meta).join(long, "column_name").select("position", "column_name", "dtype", "non_null")


def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """First rows (by ``order_by`` when given, so the result is deterministic)."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def describe(df: DataFrame, cols: Sequence[str], exact: bool | str = "auto",
             max_distinct: int = MAX_EXACT_DISTINCT) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column (long form).

    Two passes: one wide aggregate (moments, min/max and a distinct-count sketch
    that picks the frequency or the bracket path; both are exact), then the quartiles.
    """
    stats = df.agg(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.count(F.col(c)).alias("count"), F.avg(F.col(c).cast("double")).alias("mean"),
        F.stddev_samp(F.col(c).cast("double")).alias("std"), F.min(F.col(c).cast("double")).alias("min"),
        F.max(F.col(c).cast("double")).alias("max"), F.approx_count_distinct(F.col(c)).alias("d"))
        for c in cols]).alias("s")).select(F.inline("s")).collect()
    if exact == "auto":  # both choices are exact; the sketch only picks the cheaper path
        exact = True if max((r["d"] for r in stats), default=0) <= max_distinct else "bracket"
    base = local_table(df.sparkSession, [tuple(r)[:6] for r in stats],
                       "feature string, count bigint, mean double, std double, min double, max double")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value")
    q = quantiles(long, "value", [0.25, 0.5, 0.75], by=["feature"], exact=exact)
    q = q.select("feature", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"))
    return base.join(q, "feature", "left")  # an all-null column keeps its row (count 0)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``(level, n)``."""
    return df.groupBy(F.col(col).alias("level")).agg(F.count(F.lit(1)).alias("n"))


def _range(df: DataFrame, col: str) -> tuple[float, float, int]:
    r = df.agg(F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double")), F.count(col)).first()
    return r[0], r[1], r[2]


def bin_index(col: str, lo: float, hi: float, bins: int):
    """Equal-width bin in ``[0, bins)``; the maximum falls in the last bin."""
    if hi == lo:
        return F.lit(0).cast("bigint")
    b = F.floor((F.col(col).cast("double") - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("bigint")
    return F.least(b, F.lit(bins - 1).cast("bigint"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """``(bin, lo, hi, n)`` over equal-width bins between min and max."""
    lo, hi, _ = _range(df, col)
    if lo is None:  # no values: no bins
        return df.sparkSession.createDataFrame([], "bin bigint, lo double, hi double, n bigint")
    width = (hi - lo) / bins
    every = df.sparkSession.range(bins if hi > lo else 1).select(F.col("id").alias("bin"))
    counts = (df.where(F.col(col).isNotNull()).groupBy(bin_index(col, lo, hi, bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    counts = every.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counts.select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                         (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n")


def pair_bins(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """2-D equal-width bin counts ``(bx, by, n)`` (the scatter behind a pair plot)."""
    r = df.agg(F.min(F.col(x).cast("double")), F.max(F.col(x).cast("double")),
               F.min(F.col(y).cast("double")), F.max(F.col(y).cast("double"))).first()
    if r[0] is None or r[2] is None:
        return df.sparkSession.createDataFrame([], "bx bigint, by bigint, n bigint")
    side = lambda lo, hi: bins if hi > lo else 1
    every = df.sparkSession.range(side(r[0], r[1]) * side(r[2], r[3])).select(
        F.floor(F.col("id") / side(r[2], r[3])).cast("bigint").alias("bx"),
        (F.col("id") % side(r[2], r[3])).alias("by"))
    counts = (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
              .groupBy(bin_index(x, r[0], r[1], bins).alias("bx"), bin_index(y, r[2], r[3], bins).alias("by"))
              .agg(F.count(F.lit(1)).alias("n")))
    return every.join(counts, ["bx", "by"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def all_pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """R13 for every pair of ``cols`` (column order) in one pass: ``(x, y, bx, by, n)``, bins with rows.

    The bins of all columns are computed once per row; a row then counts once per pair.
    """
    ends = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in cols
                    for n, f in (("lo", F.min), ("hi", F.max))]).first()
    used = [c for c in cols if ends[f"{c}_lo"] is not None]
    binned = df.select(*[bin_index(c, ends[f"{c}_lo"], ends[f"{c}_hi"], bins).alias(f"b{i}")
                         if ends[f"{c}_hi"] > ends[f"{c}_lo"]
                         else F.when(F.col(c).isNotNull(), F.lit(0).cast("bigint")).alias(f"b{i}")
                         for i, c in enumerate(used)])
    # rows meet as (bins of all columns, count): a row is not multiplied by the pairs before that
    cells = binned.groupBy(*binned.columns).agg(F.count(F.lit(1)).alias("c"))
    pairs = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"b{i}").alias("bx"), F.col(f"b{j}").alias("by"))
             for i, a in enumerate(used) for j, b in enumerate(used) if i < j]
    if not pairs:
        return df.sparkSession.createDataFrame([], "x string, y string, bx bigint, by bigint, n bigint")
    return (cells.select("c", F.explode(F.array(*pairs)).alias("p")).where("p.bx is not null and p.by is not null")
            .groupBy("p.x", "p.y", "p.bx", "p.by").agg(F.sum("c").alias("n")))


def density(df: DataFrame, col: str, bins: int = 50, grid: int = 200) -> DataFrame:
    """Gaussian kernel density (Scott bandwidth) on ``grid`` points, from binned counts.

    The data pass is one bin-count aggregate; the (bounded) bin table is folded
    into an array and each grid point sums over it with ``aggregate`` — no join.
    """
    st = df.agg(F.min(F.col(col).cast("double")), F.max(F.col(col).cast("double")),
                F.count(col), F.stddev_samp(F.col(col).cast("double"))).first()
    lo, hi, n, sd = st[0], st[1], st[2], st[3]
    if not n or not sd:  # no values or a constant column: the kernel density is undefined
        return df.sparkSession.range(grid).select(
            F.col("id").alias("i"), F.lit(lo).cast("double").alias("x"), F.lit(None).cast("double").alias("density"))
    h = sd * n ** (-0.2)
    width = (hi - lo) / bins
    step = (hi - lo) / (grid - 1)
    counts = (df.where(F.col(col).isNotNull()).groupBy(bin_index(col, lo, hi, bins).alias("b"))
              .agg(F.count(F.lit(1)).alias("c")))
    packed = counts.agg(F.collect_list(F.struct(
        (F.lit(lo) + (F.col("b") + F.lit(0.5)) * F.lit(width)).alias("centre"), F.col("c"))).alias("bins"))
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    pts = packed.select(F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"), "bins")
    pts = pts.withColumn("x", F.lit(lo) + F.col("i") * F.lit(step))
    dens = F.aggregate("bins", F.lit(0.0), lambda acc, b: acc + b["c"] * F.exp(
        F.lit(-0.5) * F.pow((F.col("x") - b["centre"]) / F.lit(h), 2)))
    return pts.select(F.col("i").cast("bigint").alias("i"), "x", (dens * F.lit(norm)).alias("density"))


def box_stats(df: DataFrame, value: str, by: str, exact: bool | str = "auto") -> tuple[DataFrame, DataFrame]:
    """Per-group quartiles, 1.5 IQR whiskers clipped to the data, and the outlier rows.

    Returns ``(stats, outliers)``.  Group fences (one row per group) are broadcast
    back to the rows below a checked number of groups and joined otherwise; no group
    is gathered in one task.  A group without values keeps its row, with nulls and n = 0.
    """
    q = quantiles(df, value, [0.25, 0.5, 0.75], by=[by], exact=exact)
    fences = q.select(F.col(by).alias("_g"), F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                      F.col("q")[2].alias("q3"))
    rows = fences.limit(MAX_GROUPS + 1).collect()
    if len(rows) <= MAX_GROUPS:
        fences = F.broadcast(local_table(df.sparkSession, [tuple(r) for r in rows], T.StructType([
            T.StructField("_g", df.schema[by].dataType), T.StructField("q1", T.DoubleType()),
            T.StructField("median", T.DoubleType()), T.StructField("q3", T.DoubleType())])))
    fences = (fences.withColumn("lo_fence", F.col("q1") - F.lit(1.5) * (F.col("q3") - F.col("q1")))
              .withColumn("hi_fence", F.col("q3") + F.lit(1.5) * (F.col("q3") - F.col("q1"))))
    v = F.col(value).cast("double")
    tagged = df.join(fences, df[by].eqNullSafe(fences["_g"]), "left")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    stats = tagged.groupBy(by).agg(
        F.count(v).alias("n"), F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.min(F.when(inside, v)).alias("whisker_lo"),
        F.max(F.when(inside, v)).alias("whisker_hi"),
        F.count(F.when(~inside, 1)).alias("n_outliers"))
    outliers = tagged.where(~inside).drop("_g", "q1", "median", "q3", "lo_fence", "hi_fence")
    return stats, outliers


def correlation_long(df: DataFrame, cols: Sequence[str], method: str = "gram") -> DataFrame:
    """Pearson ``(a, b, r)`` for every pair ``a < b`` (column order), over the rows that have both.

    ``gram``, at every width: the sums of all pairs from masked Gram products per batch,
    added up per pair.  ``pairs``: one aggregate of ``corr(a, b)`` per pair, the same result.
    """
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    if method == "pairs":
        wide = df.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                         F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"))
                                for a, b in pairs]).alias("s"))
        return wide.select(F.inline("s"))
    return _correlation_gram(df, cols)


def _correlation_gram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations from masked Gram sums (values shifted by the column means)."""
    import numpy as np
    import pyarrow as pa

    narrow = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    d = len(cols)
    shift = np.array([m or 0.0 for m in narrow.agg(*[F.avg(c) for c in narrow.columns]).first()])
    at = [(i, j) for i in range(d) for j in range(i + 1, d)]
    rows, columns = (np.array(x) for x in zip(*at))

    def run(batches):
        total = np.zeros((6, d, d))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            m = np.column_stack([np.asarray(c.is_valid()) for c in b.columns]).astype(float)
            x = np.where(m > 0, x - shift, 0.0)
            total += np.array([m.T @ m, x.T @ m, m.T @ x, x.T @ x, (x * x).T @ m, m.T @ (x * x)])
        part = total[:, rows, columns]
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(columns)] + [pa.array(p) for p in part],
                                         ["i", "j", "n", "sa", "sb", "sab", "saa", "sbb"])

    sums = "n double, sa double, sb double, sab double, saa double, sbb double"
    s = narrow.mapInArrow(run, f"i long, j long, {sums}").groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "sa", "sb", "sab", "saa", "sbb")])
    va, vb = F.col("saa") - F.col("sa") ** 2 / F.col("n"), F.col("sbb") - F.col("sb") ** 2 / F.col("n")
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    # a constant column leaves only rounding in its variance
    flat = (va <= 1e-13 * F.col("saa")) | (vb <= 1e-13 * F.col("sbb"))
    r = F.when(F.col("n") > 0, F.when(~flat, cov / F.sqrt(va * vb)))
    name = F.array(*[F.lit(c) for c in cols])
    return s.select(F.element_at(name, (F.col("i") + 1).cast("int")).alias("a"),
                    F.element_at(name, (F.col("j") + 1).cast("int")).alias("b"), r.alias("r"))

"""Training statistics (A1-A3, A6) as small DataFrames.

All numeric statistics come from one wide aggregate; all level counts from one
``unpivot`` + ``groupBy`` (map-side combined, so a hot level collapses to one
partial count per task before the shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_LEVEL = "nan"  # key under which null categorical values are counted


def level_key(df: DataFrame, col: str) -> Column:
    """String level key: booleans as ``True``/``False``, nulls as ``nan``."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, T.BooleanType):
        s = F.initcap(c.cast("string"))
    else:
        s = c.cast("string")
    return F.coalesce(s, F.lit(NULL_LEVEL))


def numeric_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, rows, n, mean, std, std_pop, min, max)``; mean/std of an all-null column are 0.

    ``rows`` is the table's row count, ``n`` the non-null count of the feature.
    """
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "feature string, rows bigint, n bigint, mean double, std double, std_pop double, "
                "min double, max double")
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("feature"),
            F.count(F.lit(1)).alias("rows"),
            F.count(x).alias("n"),
            F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"),
            F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("std"),
            F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias("std_pop"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        ))
    return df.agg(F.array(*aggs).alias("s")).select(F.inline("s"))


def level_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, level, n)`` for every categorical column, nulls under ``nan``."""
    if not cols:
        return df.sparkSession.createDataFrame([], "feature string, level string, n bigint")
    keyed = df.select(*[level_key(df, c).alias(c) for c in cols])
    long = keyed.unpivot([], list(cols), "feature", "level")
    return long.groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))


def mode_levels(counts: DataFrame) -> DataFrame:
    """Most frequent level per feature; ties go to the lexicographically largest level."""
    return counts.groupBy("feature").agg(
        F.max_by("level", F.struct("n", "level")).alias("mode"),
        F.max("n").alias("n"))


def training_stats(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str],
                   max_rows: int) -> tuple[dict[str, dict], list[tuple[str, str, int]], int]:
    """A1-A3: numeric moments from one wide aggregate, level counts from one ``unpivot`` over the categoricals.

    Each aggregate reads its own columns only, so together they read the table once; no numeric
    passes through the unpivot.  At most ``max_rows`` (feature, level) groups are collected.

    Returns ``({feature: {n, mean, std, std_pop, min, max}}, [(feature, level, n)], rows)``.
    """
    found = {r["feature"]: r.asDict() for r in numeric_stats(df, num_cols).collect()}
    got = level_counts(df, cat_cols).limit(max_rows + 1).collect() if cat_cols else []
    if len(got) > max_rows:
        raise ValueError(f"more than {max_rows} (feature, level) groups")
    levels = [(r["feature"], r["level"], int(r["n"])) for r in got]
    if found:
        n_rows = int(next(iter(found.values()))["rows"])
    else:  # every row has one level of each categorical
        n_rows = sum(n for c, _, n in levels if c == cat_cols[0]) if cat_cols else df.count()
    return found, levels, n_rows

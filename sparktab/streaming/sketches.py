"""Mergeable window statistics (X6): quantile sketches stored per window, merged to longer periods without rereading.

A window keeps its count, sum, maximum and a KLL sketch of its values (``K`` items and a few more,
however many values it has).  Windows merge by one aggregate over the stored table, so
a month's quantiles come from its days.  Up to ``K`` values a sketch holds them all and
quantiles are exact (the value of rank ceil(p n)); beyond, the rank is off by at most
``rank_error(K)`` of n, with 99 % probability, for merged sketches too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

K = 4096


def rank_error(k: int = K) -> float:
    """The published bound of a KLL sketch's rank error, as a share of the number of values."""
    return 2.296 / k ** 0.9723


def event_time(df: DataFrame, ts: str) -> Column:
    """A timestamp; a wall clock without zone is taken as UTC, whatever the session's zone."""
    at = F.col(ts)
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), at)
    return at.cast("timestamp")


def window_sketches(events: DataFrame, ts: str = "ts", value: str = "value", window: str = "1 day",
                    by: Sequence[str] = ("event_type",), k: int = K, delay: str | None = None) -> DataFrame:
    """(window_start, by..., n, total, greatest, sketch) of a table, or with ``delay`` of a stream (append mode)."""
    ev = events.withColumn("_et", event_time(events, ts))
    if delay is not None:
        ev = ev.withWatermark("_et", delay)
    v = F.col(value).cast("double")
    out = ev.where(v.isNotNull() & ~F.isnan(v)).groupBy(F.window("_et", window).alias("w"), *by).agg(
        F.count(v).alias("n"), F.sum(v).alias("total"), F.max(v).alias("greatest"), F.kll_sketch_agg_double(v, k).alias("sketch"))
    return out.select(F.col("w.start").alias("window_start"), *by, "n", "total", "greatest", "sketch")


def merge_windows(stored: DataFrame, by: Sequence[Column | str], probabilities: Sequence[float] = (0.5, 0.95),
                  k: int = K) -> DataFrame:
    """(by..., n, mean, greatest, p50, p95...) of longer periods, from stored windows alone."""
    out = stored.groupBy(*by).agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"),
                                  F.max("greatest").alias("greatest"), F.kll_merge_agg_double("sketch", k).alias("sketch"))
    quantiles = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"p{p * 100:g}") for p in probabilities]
    return out.select(*[c for c in out.columns if c != "sketch"], *quantiles)

"""Error aggregates.

One aggregate per call; ``by`` turns it into per-slice metrics.  Only rows with both a
target and a prediction count (``n``); the others are reported as ``n_unscored``.  R² uses
``var_pop(y) * n`` for the total sum of squares (numerically stable, one pass):
null for fewer than two rows; for a constant target 1.0 when every prediction
is exact, else 0.0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _metric_columns(y: str, p: str) -> dict[str, Column]:
    e = F.col(y).cast("double") - F.col(p).cast("double")
    n = F.count(e)
    sse = F.sum(e * e)
    sst = F.var_pop(F.when(e.isNotNull(), F.col(y).cast("double"))) * n
    r2 = (F.when(n < 2, F.lit(None).cast("double"))
          .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - sse / sst))
    return {"n": n, "mae": F.avg(F.abs(e)), "mse": F.avg(e * e), "rmse": F.sqrt(F.avg(e * e)), "r2": r2,
            "n_unscored": F.count(F.lit(1)) - n}


def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred",
                       by: Sequence[str] = ()) -> DataFrame:
    aggs = [c.alias(name) for name, c in _metric_columns(y, p).items()]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def metrics_per_column(df: DataFrame, y: str, predictions: dict[str, str], label: str) -> DataFrame:
    """One row per prediction column (``predictions``: label to column) from one aggregate, without multiplying rows."""
    rows = [F.struct(F.lit(name).alias(label), *[c.alias(k) for k, c in _metric_columns(y, p).items()])
            for name, p in predictions.items()]
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def rmsle(df: DataFrame, y: str = "y_true", p: str = "y_pred", by: Sequence[str] = ()) -> DataFrame:
    """A5: root mean squared log error; null (with ``n_negative`` > 0) if any value is negative."""
    yt, yp = F.col(y).cast("double"), F.col(p).cast("double")
    neg = F.count(F.when((yt < 0) | (yp < 0), 1))
    both = yt.isNotNull() & yp.isNotNull()
    d = F.when((yt > -1) & (yp > -1), F.log1p(yt) - F.log1p(yp))
    val = F.when(neg > 0, F.lit(None).cast("double")).otherwise(F.sqrt(F.avg(d * d)))
    aggs = [F.count(F.when(both, 1)).alias("n"), neg.cast("bigint").alias("n_negative"), val.alias("rmsle")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def with_residual(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """``residual = y_true - y_pred``."""
    return df.withColumn("residual", F.col(y).cast("double") - F.col(p).cast("double"))

"""Scoring (C1-C6).

A fitted linear model is a column expression, so scoring is a projection that
stays in whole-stage codegen.  Pinned runs are joined as a table of coefficients; run
comparisons are one column per run.  The requests are scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .features import FeatureModel, align_records, impute, imputed_map, is_missing
from .metrics import metrics_per_column
from .models import PRED, LinearModel, predict
from .stats import level_key

MAX_BROADCAST_MODELS = 10_000  # so many coefficient rows are broadcast; more are joined


def score_holdout(df: DataFrame, model: LinearModel, target: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., y_true, y_pred, residual)``."""
    y = F.col(target).cast("double")
    p = model.predict_col(df)
    return df.select(*keys, y.alias("y_true"), p.alias("y_pred"), (y - p).alias("residual"))


def score_strict(records: DataFrame, features_col: str, fm: FeatureModel, model) -> tuple[DataFrame, DataFrame]:
    """Every expected feature must be present; returns (scored, rejects).  Linear or tree model."""
    ok, rejects = align_records(records, features_col, fm.numeric, fm.categorical)
    return predict(model, ok, fm), rejects


def score_partial(requests: DataFrame, fm: FeatureModel, model, keep: Sequence[str] = ()) -> DataFrame:
    """Impute missing fields, score with a linear or tree model, and report what was imputed.

    ``requests`` carries the feature columns (nullable, any may be absent).
    Output: ``keep..., used_features struct, imputed map<string,string>, y_pred``.
    """
    cols = fm.numeric + fm.categorical
    df = requests
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.withColumn("imputed", imputed_map(fm, cols))
    scored = predict(model, impute(df, fm, cols), fm)
    return scored.select(*keep, F.struct(*[F.col(c) for c in cols]).alias("used_features"), "imputed", PRED)


def score_pinned(requests: DataFrame, run_col: str, models: Mapping[str, LinearModel]) -> DataFrame:
    """C4: score each request with the model its ``run_col`` names.

    Known ids get ``status = 'ok'``; unknown ids ``'not_found'`` with a null
    prediction (the reference's 404, as data).  The models become a table of
    coefficients, one narrow row per run, joined on the run id (broadcast below a
    checked number of runs); the prediction is one expression, however many runs there are.
    """
    spark = requests.sparkSession
    numeric = sorted({c for m in models.values() for c, *_ in m.numeric})
    levels = sorted({c for m in models.values() for c, _ in m.categorical})
    schema = "_id string, _b double" + "".join(f", _n{i} struct<mean:double,scale:double,w:double>"
                                              for i in range(len(numeric))) + "".join(
        f", _l{i} map<string,double>" for i in range(len(levels)))
    rows = []
    for run_id, m in sorted(models.items()):
        num, cat = {c: (mean, scale, w) for c, mean, scale, w in m.numeric}, {c: dict(lw) for c, lw in m.categorical}
        rows.append((run_id, m.intercept, *[num.get(c) for c in numeric], *[cat.get(c) for c in levels]))
    table = spark.createDataFrame(rows, schema)
    if len(rows) <= MAX_BROADCAST_MODELS:
        table = F.broadcast(table)
    pred = F.col("_b")
    for i, c in enumerate(numeric):  # a run without the feature skips the term
        k = F.col(f"_n{i}")
        term = k["w"] * ((F.col(c).cast("double") - k["mean"]) / k["scale"])
        pred = pred + F.when(k.isNull(), F.lit(0.0)).otherwise(term)
    for i, c in enumerate(levels):
        pred = pred + F.coalesce(F.try_element_at(F.col(f"_l{i}"), level_key(requests, c)), F.lit(0.0))
    out = requests.join(table, F.col(run_col).cast("string") == F.col("_id"), "left")
    return out.select(*requests.columns, F.when(F.col("_id").isNotNull(), F.lit("ok")).otherwise(
        F.lit("not_found")).alias("status"), F.when(F.col("_id").isNotNull(), pred).alias(PRED))


def compare_runs(holdout: DataFrame, target: str, models: Mapping[str, LinearModel]) -> DataFrame:
    """Hold-out metrics for several runs from one scan and one aggregate (one prediction column per run)."""
    runs = sorted(models)
    wide = holdout.select(F.col(target).cast("double").alias("y_true"),
                          *[models[r].predict_col(holdout).alias(f"p{i}") for i, r in enumerate(runs)])
    return metrics_per_column(wide, "y_true", {r: f"p{i}" for i, r in enumerate(runs)}, "run_id")


def prediction_log(scored: DataFrame, run_id: str, input_cols: Sequence[str],
                   model_type: str | None = None) -> DataFrame:
    """Rows for the append-only ``predictions_log`` table."""
    return scored.select(F.lit(run_id).alias("model_run_id"), F.lit(model_type).alias("model_type"), F.current_timestamp().alias("ts"),
                         F.to_json(F.struct(*[F.col(c) for c in input_cols])).alias("inputs"),
                         F.col(PRED).alias("prediction"))


__all__ = ["score_holdout", "score_strict", "score_partial", "score_pinned", "compare_runs",
           "prediction_log", "is_missing"]

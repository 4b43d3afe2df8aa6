"""Composite jobs (J1-J5) with their runs recorded in the ledger.

Design decisions that differ from the reference (see README):

* one split serves all stages of a workflow (a side-partitioned table for large
  inputs, persisted for small ones), with one deferred ledger write;
* each stage is its own run (``parent_id`` links them), so lookups by stage work;
* lookups consider ``FINISHED`` runs only;
* the split seed and share are stored on the run and reused by evaluation;
* statistics are read through ``feature_run_id``, not from the training run.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from ..operators.features import MAX_LEVELS, FeatureModel, fit_features
from ..operators.ledger import FAILED, FINISHED, Ledger
from ..operators.metrics import regression_metrics
from ..operators.model_tables import score_requests, write_nodes
from ..operators.models import LinearModel, fit_gbt, fit_linear, predict
from ..operators.roles import infer_roles
from ..operators.scoring import prediction_log, score_holdout, score_strict
from ..operators.search import RUNGS, loss_history, random_search
from ..operators.split import TEST, TRAIN, exact_split, hash_split, materialize_split
from ..operators.wide import fit_least_squares
from ..session import delete_path, input_bytes, scratch_path, tune_for_input
from ..sources.tables import read_table, write_table

MODEL_TYPES = ("linear_regression", "gbt")
SPLIT_TABLE_MIN_BYTES = 256 << 20
# Keys under which runs record parameters and metrics.
METRICS = ("mae", "mse", "rmse", "r2")
DATA_ROWS, DATA_COLUMNS, DATA_MEMORY = "data_rows", "data_columns", "data_memory_mb"
N_NUMERIC, N_CATEGORICAL, N_ENCODED = "num_numeric_features", "num_categorical_features", "total_transformed_features"
TRAIN_LOSS, TRAIN_MAE, EVAL = "train_loss_final", "train_mae_final", "eval_"
EVALUATED_RUN, EVALUATED_TYPE, DATASET = "evaluated_model_run_id", "evaluated_model_type", "workflow_dataset_path"

SPLIT_METHODS = ("exact", "hash")


@dataclass(frozen=True)
class JobSpec:
    data_path: str
    target: str
    ledger_root: str
    keys: tuple[str, ...] = ()            # split keys; default: every non-target column
    index_column: str | None = None       # row identity, kept out of the features
    exclude: tuple[str, ...] = ()         # other non-feature columns
    test_size: float = 0.2
    seed: int = 42
    split_method: str = "exact"           # exact: ceil(n * test_size) test rows; hash: stateless threshold
    model_type: str = "linear_regression"
    hyperparameters: dict = field(default_factory=dict)
    data_format: str | None = None
    auto_tune: bool = False               # size shuffle partitions from the input bytes
    predictions_format: str = "parquet"   # hold-out predictions sink: parquet or csv
    max_levels: int = MAX_LEVELS          # a categorical with more levels is refused; wide designs are solved in blocks

    def __post_init__(self):
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"model_type must be one of {MODEL_TYPES}, got {self.model_type!r}")
        if self.split_method not in SPLIT_METHODS:
            raise ValueError(f"split_method must be one of {SPLIT_METHODS}, got {self.split_method!r}")
        if self.model_type == "linear_regression" and {k: v for k, v in self.hyperparameters.items()
                                                       if (k, v) != ("fit_intercept", True)}:
            raise ValueError("least squares has an intercept and no other option; "
                             f"got {dict(self.hyperparameters)}")


def load(spark: SparkSession, spec: JobSpec) -> DataFrame:
    if spec.auto_tune:
        tune_for_input(spark, input_bytes(spark, spec.data_path))
    df = read_table(spark, spec.data_path, spec.data_format)
    if spec.target not in df.columns:
        raise KeyError(f"the table has no target column {spec.target!r}")
    return df


def _index(df: DataFrame, spec: JobSpec) -> list[str]:
    """The index column, where the table has it."""
    return [spec.index_column] if spec.index_column in df.columns else []


def split_keys(df: DataFrame, spec: JobSpec) -> list[str]:
    return list(spec.keys) or _index(df, spec) or [c for c in df.columns if c not in (spec.target, "split")]


def split(df: DataFrame, spec: JobSpec, seed: int | None = None, test_size: float | None = None,
          keys: Sequence[str] | None = None, method: str | None = None) -> DataFrame:
    cut = exact_split if (method or spec.split_method) == "exact" else hash_split
    return cut(df, list(keys or split_keys(df, spec)), spec.test_size if test_size is None else test_size,
               spec.seed if seed is None else seed)


def _split_as(spark: SparkSession, spec: JobSpec, ledger: Ledger, run: dict) -> DataFrame:
    """The data split as the run recorded it: seed, share, keys and method."""
    keys = ledger.param(run["run_id"], "split_keys")
    return split(load(spark, spec), spec, int(run["split_seed"]), float(run["test_size"]),
                 json.loads(keys) if keys else None, ledger.param(run["run_id"], "split_method"))


def _exclude(spec: JobSpec) -> list[str]:
    return [spec.target, "split"] + ([spec.index_column] if spec.index_column else []) + list(spec.exclude)


def fit_and_score(df: DataFrame, keys: Sequence[str], target: str, exclude: Sequence[str] = (),
                  test_size: float = 0.2, seed: int = 42):
    """Split, fit the encoding and the least-squares model on train, score the hold-out.

    Returns ``(scored hold-out, FeatureModel, LinearModel)``.  Three column-pruned
    scans: statistics (one aggregate), Gram sums (one aggregate), scoring.
    """
    s = hash_split(df, keys, test_size, seed)
    roles = infer_roles(s, exclude=list(exclude) + [target, "split"])
    train = s.where(F.col("split") == TRAIN)
    fm = fit_features(train, roles, target=target)
    lm = fit_linear(train, fm, target)
    scored = score_holdout(s.where(F.col("split") == TEST), lm, target, keys)
    return scored, fm, lm


# --- J1 ------------------------------------------------------------------------

def run_feature_engineering(spark: SparkSession, spec: JobSpec, parent_id: str | None = None,
                            split_df: DataFrame | None = None, ledger: Ledger | None = None) -> str:
    ledger = ledger or Ledger(spark, spec.ledger_root)
    run_id = ledger.start_run("feature_engineering", parent_id=parent_id, split_seed=spec.seed,
                              test_size=spec.test_size)
    try:
        df = split_df if split_df is not None else split(load(spark, spec), spec)
        summary, nulls = profile.summary_and_nulls(df.drop("split"))  # one pass: R3-R5
        roles = infer_roles(df, exclude=_exclude(spec))
        fm = fit_features(df.where(F.col("split") == TRAIN), roles, target=spec.target,
                          max_levels=spec.max_levels)
        ledger.log_artifact(run_id, None, "feature_model", content=fm.to_json())
        ledger.log_artifact(run_id, None, "null_counts", content=json.dumps(nulls))
        ledger.log_params(run_id, {
            DATA_ROWS: summary["n_rows"], DATA_COLUMNS: summary["n_columns"],
            DATA_MEMORY: summary["memory_mb"], N_NUMERIC: len(fm.numeric),
            N_CATEGORICAL: len(fm.categorical),
            N_ENCODED: len(fm.feature_names),
            "split_keys": json.dumps(split_keys(df, spec)), "split_method": spec.split_method,
            "dropped_columns": json.dumps(roles.dropped)})
        ledger.end_run(run_id, FINISHED)
    except Exception:
        ledger.end_run(run_id, FAILED)
        raise
    return run_id


def load_feature_model(spark: SparkSession, ledger: Ledger, feature_run_id: str) -> FeatureModel:
    text = ledger.artifact_text(feature_run_id, "feature_model")
    if text is None:
        raise LookupError(f"feature run {feature_run_id} has no feature model")
    return FeatureModel.from_json(text)


# --- J2 --------------------------------------------------------------------------

def run_training(spark: SparkSession, spec: JobSpec, parent_id: str | None = None,
                 feature_run_id: str | None = None, split_df: DataFrame | None = None,
                 ledger: Ledger | None = None) -> str:
    ledger = ledger or Ledger(spark, spec.ledger_root)
    if feature_run_id is None:
        latest = ledger.latest_run("feature_engineering")
        feature_run_id = (latest["run_id"] if latest is not None
                          else run_feature_engineering(spark, spec, parent_id, ledger=ledger))
    fr = ledger.run_row(feature_run_id)
    if fr is None:
        raise LookupError(f"Run {feature_run_id} not found")
    seed, test_size = int(fr["split_seed"]), float(fr["test_size"])
    run_id = ledger.start_run("training", parent_id=parent_id, model_type=spec.model_type,
                              feature_run_id=feature_run_id, split_seed=seed, test_size=test_size)
    try:
        fm = load_feature_model(spark, ledger, feature_run_id)
        df = split_df if split_df is not None else _split_as(spark, spec, ledger, fr)
        train, test = df.where(F.col("split") == TRAIN), df.where(F.col("split") == TEST)
        art = ledger.artifact_dir(run_id)
        if spec.model_type == "linear_regression":
            model = fit_least_squares(train, fm, spec.target)
            ledger.log_artifact(run_id, None, spec.model_type, content=model.to_json())
        else:
            model = fit_gbt(train, fm.numeric, fm.categorical, spec.target, **spec.hyperparameters)
            path = os.path.join(art, "model")
            model.write().overwrite().save(path)
            write_nodes(ledger, run_id, model, path, fm.numeric, fm.categorical)
            ledger.log_artifact(run_id, path, spec.model_type)
            for i, loss in enumerate(loss_history(model, train, fm.numeric, fm.categorical, spec.target)):
                ledger.log_metrics(run_id, {"train_loss": loss}, step=i + 1)
        _write_predictions(ledger, run_id, holdout(test, model, fm, spec), spec)
        # hold-out metrics and M6's final training-side loss/error from one grouped aggregate
        both = predict(model, df, fm).select("split", F.col(spec.target).cast("double").alias("y_true"), "y_pred")
        by_side = {r["split"]: r.asDict() for r in regression_metrics(both, by=["split"]).collect()}
        none = dict.fromkeys([*METRICS, "n_unscored"])  # a side without rows (hash split of a small table)
        m, tm = by_side.get(TEST, none), by_side.get(TRAIN, none)
        ledger.log_artifact(run_id, None, "metrics", content=json.dumps({k: m[k] for k in METRICS}))
        ledger.log_metrics(run_id, {**{k: m[k] for k in METRICS},
                                    TRAIN_LOSS: tm["mse"], TRAIN_MAE: tm["mae"]})
        # rows with a null target or numeric take no part in the fit
        kept = {k: ledger.param(feature_run_id, k) for k in ("split_keys", "split_method")}
        ledger.log_params(run_id, {"model_type": spec.model_type, "test_size": test_size,
                                   "random_state": seed, "train_rows_left_out": tm["n_unscored"],
                                   **{k: v for k, v in kept.items() if v},
                                   **{f"model_{k}": v for k, v in spec.hyperparameters.items()}})
        ledger.end_run(run_id, FINISHED)
    except Exception:
        ledger.end_run(run_id, FAILED)
        raise
    return run_id


def holdout(test: DataFrame, model, fm: FeatureModel, spec: JobSpec) -> DataFrame:
    """C1/P7 for a linear or tree model: ``(index?, y_true, y_pred, residual)``."""
    y = F.col(spec.target).cast("double")
    return predict(model, test, fm).select(*_index(test, spec), y.alias("y_true"), "y_pred",
                                           (y - F.col("y_pred")).alias("residual"))


def _write_predictions(ledger: Ledger, run_id: str, scored: DataFrame, spec: JobSpec) -> None:
    path = os.path.join(ledger.artifact_dir(run_id), "predictions")
    write_table(scored, path, fmt=spec.predictions_format)
    ledger.log_artifact(run_id, path, "predictions")


def load_model(spark: SparkSession, ledger: Ledger, run_id: str):
    """The fitted model of a training run, with its type."""
    run = ledger.run_row(run_id)
    if run is None:
        raise LookupError(f"Run {run_id} not found")
    if run["model_type"] == "linear_regression":
        text = ledger.artifact_text(run_id, run["model_type"])
        if text is None:
            raise LookupError(f"run {run_id} has no model")
        return LinearModel.from_json(text), run
    path = ledger.artifact_path(run_id, run["model_type"])
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path), run


# --- J3 ---------------------------------------------------------------------------

def run_evaluation(spark: SparkSession, spec: JobSpec, model_run_id: str | None = None,
                   parent_id: str | None = None, split_df: DataFrame | None = None,
                   ledger: Ledger | None = None) -> str:
    ledger = ledger or Ledger(spark, spec.ledger_root)
    if model_run_id is None:
        latest = ledger.latest_run("training")
        if latest is None:
            raise LookupError("No finished training run found")
        model_run_id = latest["run_id"]
    model, mrun = load_model(spark, ledger, model_run_id)
    run_id = ledger.start_run("evaluation", parent_id=parent_id, model_type=mrun["model_type"],
                              feature_run_id=mrun["feature_run_id"], split_seed=mrun["split_seed"],
                              test_size=mrun["test_size"])
    try:
        df = split_df if split_df is not None else _split_as(spark, spec, ledger, mrun)
        fm = load_feature_model(spark, ledger, mrun["feature_run_id"])
        scored = holdout(df.where(F.col("split") == TEST), model, fm, spec)
        _write_predictions(ledger, run_id, scored, spec)
        m = regression_metrics(scored).first().asDict()
        ledger.log_metrics(run_id, {EVAL + k: m[k] for k in METRICS})
        ledger.log_artifact(run_id, None, "metrics", content=json.dumps({k: m[k] for k in METRICS}))
        ledger.log_params(run_id, {EVALUATED_RUN: model_run_id,
                                   EVALUATED_TYPE: mrun["model_type"]})
        ledger.end_run(run_id, FINISHED)
    except Exception:
        ledger.end_run(run_id, FAILED)
        raise
    return run_id


# --- J4 ------------------------------------------------------------------------------

def run_prediction(spark: SparkSession, spec: JobSpec, records: DataFrame | str, features_col: str = "features",
                   run_id: str | None = None, out_dir: str | None = None,
                   whole_files: bool = False) -> tuple[DataFrame, DataFrame]:
    """Strictly score map records with a (pinned or latest) training run, linear or tree.

    ``records`` is a DataFrame with a ``map<string,string>`` column or a path of
    JSON records (S4: one object per line, or ``whole_files``).  Returns ``(scored,
    rejects)``.  With ``out_dir`` the scored rows are appended to ``predictions_log`` and
    the rejects to ``rejects``; a ``prediction`` run records the model run and counts.
    """
    if isinstance(records, str):
        from ..sources.tables import read_records
        records, features_col = read_records(spark, records, whole_files=whole_files), "features"
    ledger = Ledger(spark, spec.ledger_root)
    if run_id is None:
        latest = ledger.latest_run("training")
        if latest is None:
            raise LookupError("No finished training run found")
        run_id = latest["run_id"]
    model, mrun = load_model(spark, ledger, run_id)
    fm = load_feature_model(spark, ledger, mrun["feature_run_id"])
    scored, rejects = score_strict(records, features_col, fm, model)
    if out_dir:
        pred_run = ledger.start_run("prediction", model_type=mrun["model_type"], feature_run_id=mrun["feature_run_id"])
        try:
            log = os.path.join(out_dir, "predictions_log")
            write_table(prediction_log(scored, run_id, fm.numeric + fm.categorical, mrun["model_type"]), log, mode="append")
            others = [c for c in rejects.columns if c not in ("missing", "bad_cast", "status")]
            write_table(rejects.select(F.lit(pred_run).alias("run_id"), "missing", "bad_cast", "status", *others),
                        os.path.join(out_dir, "rejects"), mode="append")
            ledger.log_params(pred_run, {"source_run_id": run_id, "model_type": mrun["model_type"]})
            ledger.log_artifact(pred_run, log, "predictions_log")
            ledger.end_run(pred_run, FINISHED)
        except Exception:
            ledger.end_run(pred_run, FAILED)
            raise
    return scored, rejects


# --- J5 ---------------------------------------------------------------------------------

def run_offline_workflow(spark: SparkSession, spec: JobSpec) -> dict[str, str]:
    """J1 -> J2 -> J3 over one persisted split; returns ``{stage: run_id}``."""
    # one deferred ledger for the workflow and its stages: a single write at the end
    ledger = Ledger(spark, spec.ledger_root, defer=True)
    parent = ledger.start_run("workflow", split_seed=spec.seed, test_size=spec.test_size)
    # one split serves all three stages: above SPLIT_TABLE_MIN_BYTES it is written as a
    # side-partitioned table (pruned reads, cut lineage); small inputs are kept in memory
    df, path = split(load(spark, spec), spec), None
    if input_bytes(spark, spec.data_path) >= SPLIT_TABLE_MIN_BYTES:
        path = scratch_path(spark, f"split-{parent}")
        df = materialize_split(df, path)
    else:
        df = df.persist()
    try:
        fe = run_feature_engineering(spark, spec, parent, df, ledger=ledger)
        tr = run_training(spark, spec, parent, fe, df, ledger=ledger)
        ev = run_evaluation(spark, spec, tr, parent, df, ledger=ledger)
        ledger.log_params(parent, {DATASET: spec.data_path})
        ledger.log_artifact(parent, None, "workflow_summary",
                            content=json.dumps({"feature_engineering": fe, "training": tr, "evaluation": ev}))
        ledger.end_run(parent, FINISHED, model_type=spec.model_type)
    except Exception:
        ledger.end_run(parent, FAILED)
        raise
    finally:
        ledger.flush()
        df.unpersist()
        if path:
            delete_path(spark, path)
    return {"workflow": parent, "feature_engineering": fe, "training": tr, "evaluation": ev}


# --- M4-M6 as a job ---------------------------------------------------------------------

def run_tuning(spark: SparkSession, spec: JobSpec, feature_run_id: str | None = None, n_trials: int = 10,
               executions: int = 3, validation: float = 0.1, space: dict | None = None,
               rungs: Sequence[float] = RUNGS) -> dict[str, str]:
    """Search tree parameters, refit the best on all training rows and evaluate it on the hold-out.

    A share of the training rows (by key hash) validates the trials.  The ``tuning`` run records
    the trial table and the best parameters; training and evaluation are its child runs, and training
    records the loss after every round.  Returns ``{"tuning", "training", "evaluation"}``.
    """
    ledger = Ledger(spark, spec.ledger_root)
    if feature_run_id is None:
        latest = ledger.latest_run("feature_engineering")
        feature_run_id = latest["run_id"] if latest is not None else run_feature_engineering(spark, spec, ledger=ledger)
    fr = ledger.run_row(feature_run_id)
    if fr is None:
        raise LookupError(f"Run {feature_run_id} not found")
    run_id = ledger.start_run("tuning", model_type="gbt", feature_run_id=feature_run_id,
                              split_seed=fr["split_seed"], test_size=fr["test_size"])
    df = _split_as(spark, spec, ledger, fr).persist()
    try:
        fm = load_feature_model(spark, ledger, feature_run_id)
        keys = split_keys(df, spec)
        train = hash_split(df.where(F.col("split") == TRAIN), keys, validation, f"validation {spec.seed}", side_col="_part")
        table, best = random_search(train.where(F.col("_part") == TRAIN), train.where(F.col("_part") == TEST), fm.numeric,
                                    fm.categorical, spec.target, n_trials, executions, spec.seed, keys=keys,
                                    rungs=rungs, space=space, fixed=spec.hyperparameters)
        trials = [r.asDict() for r in table.collect()]
        ledger.log_artifact(run_id, None, "trials", content=json.dumps(trials))
        ledger.log_params(run_id, {f"best_{k}": v for k, v in best.items()})
        ledger.log_metrics(run_id, {"best_val_mse": trials[0]["val_mse"]})
        chosen = replace(spec, model_type="gbt", hyperparameters={**spec.hyperparameters, **best, "seed": spec.seed})
        tr = run_training(spark, chosen, run_id, feature_run_id, df, ledger=ledger)
        ev = run_evaluation(spark, chosen, tr, run_id, df, ledger=ledger)
        ledger.end_run(run_id, FINISHED)
    except Exception:
        ledger.end_run(run_id, FAILED)
        raise
    finally:
        df.unpersist()
    return {"tuning": run_id, "training": tr, "evaluation": ev}


# --- C3/C4 as a job: the scoring service's data work over a request table ---------------

def run_inference(spark: SparkSession, spec: JobSpec, requests: DataFrame, run_col: str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Impute-then-score a table of (partial) requests, routed by run id.

    Each request row may name a training run in ``run_col``; rows without one
    use the newest finished training run.  Models are joined as tables, so the
    requests are scanned once for any number of runs.  Errors become data:
    ``status = 'not_found'`` for an unknown run, ``'bad_request'`` when a numeric
    field holds text that is not a number (with the fields in ``reason``).
    Output: ``keep..., model_run_id, model_type, status, reason, used_features, imputed, y_pred``.
    """
    ledger = Ledger(spark, spec.ledger_root)
    latest = ledger.latest_run("training")
    default = F.lit(latest["run_id"] if latest is not None else None).cast("string")
    return score_requests(requests, F.coalesce(F.col(run_col), default) if run_col else default, ledger, keep)

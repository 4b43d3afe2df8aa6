"""Hyper-parameter search (M4, M5) and the training history of boosted trees (M6).

* ``random_search``: sampled tree parameters by successive halving.  Every trial is scored on a
  small hash sample of the fit rows; the better third goes on to a larger sample that
  holds the smaller one, and the last ones to all rows.  Trials that differ only in the
  number of rounds are one fit: the loss after every round of the longest one has them all.
  Where rows are many and their bins few, an execution sums them by cell once and all its fits work on these (``cells``).
* ``ridge_search``: penalties of the least-squares model by cross-validation, all trials from
  one pass.  Every fold's Gram matrix comes from one grouped aggregate; the fit without a
  fold is solved from the sum of the others, and its error on the fold follows from the fold's
  own matrix, so no row is read again.
* ``loss_history``: loss and error after each round, on any rows, in one pass.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_u32, threshold
from ..session import delete_path, local_table, scratch_path
from . import cells
from .features import FeatureModel
from .models import (ROWS_PER_PARTITION, _complete_rows, _solve, centred_design, fit_gbt, gbt_regressor, gram_by, partition_rows,
                     repacked, tree_inputs, vector_pipeline)

# The grid that trials are drawn from.
SEARCH_SPACE = {
    "maxDepth": [2, 3, 4, 5, 6],
    "maxIter": [10, 20, 30],
    "stepSize": [0.05, 0.1, 0.2, 0.3],
    "subsamplingRate": [0.6, 0.8, 1.0],
}
RUNGS = (1 / 9, 1 / 3, 1.0)  # shares of the fit rows
KEEP = 1 / 3                 # share of the trials that go on
MIN_RUNG_ROWS = 2_000        # smaller samples are not worth a rung


def sample_params(n_trials: int, seed: int, space: dict | None = None) -> list[dict]:
    """Random search: ``n_trials`` distinct draws from the grid (seeded, driver-side).

    More trials than the grid has points is an error.
    """
    space = space or SEARCH_SPACE
    rng = np.random.default_rng(seed)
    keys = sorted(space)
    seen, out = set(), []
    total = int(np.prod([len(space[k]) for k in keys]))
    if n_trials > total:
        raise ValueError(f"{n_trials} trials, but the grid has {total} points")
    while len(out) < n_trials:
        pick = tuple(space[k][int(rng.integers(len(space[k])))] for k in keys)
        if pick not in seen:
            seen.add(pick)
            out.append(dict(zip(keys, pick)))
    return out


def _packed(df: DataFrame) -> DataFrame:
    """``df`` persisted in as few partitions as ``ROWS_PER_PARTITION`` allows."""
    df = df.persist()
    n, largest = partition_rows(df)
    return repacked(df, max(1, -(-n // ROWS_PER_PARTITION)), largest)


def _losses(model, rows: DataFrame) -> list[float]:
    """Mean squared error after each round, in one job."""
    return list(model.evaluateEachIteration(rows, "squared"))


def _fits(trials: dict[int, dict], executions: int) -> list[tuple[dict, int, list[int]]]:
    """(parameters with the most rounds, execution, trials): trials that differ in the rounds alone are one fit."""
    groups: dict[str, list[int]] = {}
    for t, p in trials.items():
        groups.setdefault(json.dumps({k: v for k, v in p.items() if k != "maxIter"}, sort_keys=True), []).append(t)
    longest = [(max((trials[t] for t in group), key=lambda p: p["maxIter"]), group) for group in groups.values()]
    # the longest fits first, so that no long one is left for the end
    longest.sort(key=lambda g: -g[0]["maxIter"] * 2 ** g[0].get("maxDepth", 5))
    return [(p, e, group) for p, group in longest for e in range(executions)]


def _fitter(rows: DataFrame, valid: DataFrame, est, trials: dict[int, dict], numeric: Sequence[str], by: Sequence[str],
            target: str, encoder, executions: int, seed: int, given: set[str]):
    """(partitions, most fits at once or None, function from parameters and execution to the losses, function to free what is held):
    fits of cells where they are few, else of rows."""
    def settings(p):
        return {k: est.getOrDefault(k) for k in cells.CELL_PARAMS} | p

    held, written, sizes = [], [], []
    n = rows.count()
    bins = {settings(p)["maxBins"] for p in trials.values()}
    if n >= cells.MIN_CELL_ROWS and len(bins) == 1 and given.union(*trials.values()) <= cells.CELL_PARAMS:
        rates = sorted({settings(p)["subsamplingRate"] for p in trials.values()})
        rounds = max(settings(p)["maxIter"] for p in trials.values())
        for e in range(executions):
            cuts = cells.sampled_cuts(rows, n, numeric, max(bins), seed + e)
            if e == 0 and n < cells.MIN_ROWS_PER_CELL * cells.binned(rows, cuts).select(*by).distinct().count():
                break
            made = _packed(cells.fit_cells(rows, valid, cuts, by, target, encoder, rates, rounds, seed + e))
            sizes.append(made.count())
            partitions = made.rdd.getNumPartitions()
            written.append(scratch_path(rows.sparkSession, "cells"))
            held.append(cells.stored(made, written[-1]))
            made.unpersist()
    if held:
        def fit(p, e):
            p = settings(p)
            return cells.boosted_losses(held[e], sizes[e], rates.index(p["subsamplingRate"]), p, seed + e)
    else:
        fit_v = encoder.transform(rows).select("features", target).persist()
        val_v = encoder.transform(valid).select("features", target).persist()
        held = [fit_v, val_v]
        partitions = fit_v.rdd.getNumPartitions()

        def fit(p, e):
            return _losses(est.fit(fit_v, {getattr(est, k): v for k, v in p.items()} | {est.seed: seed + e}), val_v)

    def free():
        for path in written:
            delete_path(rows.sparkSession, path)
        for df in [] if written else held:
            df.unpersist()

    return partitions, cells.FITS_AT_ONCE if written else None, fit, free


def random_search(fit_df: DataFrame, valid_df: DataFrame, numeric: Sequence[str],
                  categorical: Sequence[str], target: str, n_trials: int = 10,
                  executions: int = 3, seed: int = 42, parallelism: int = 4, keys: Sequence[str] | None = None,
                  rungs: Sequence[float] = RUNGS, keep: float = KEEP, space: dict | None = None,
                  fixed: dict | None = None) -> tuple[DataFrame, dict]:
    """M4/M5: sampled trials x executions, scored on the validation rows (MSE), by successive halving.

    Returns the trial table (trial, params, val_mse, executions, share), best first, and the
    best parameter set.  ``share`` is the part of the fit rows that the trial was last fitted
    on; trials with a larger share rank first.  ``rungs=(1.0,)`` fits every trial on all rows.
    Rows enter a sample by the hash of ``keys`` (default: all columns).  ``space`` is the grid, ``fixed`` are
    parameters that all trials share.
    """
    from multiprocessing.pool import ThreadPool

    from pyspark.util import inheritable_thread_target

    spark = fit_df.sparkSession
    keys = list(keys or fit_df.columns)
    fit_df = fit_df.where(F.col(target).isNotNull()).withColumn("_hash", hash_u32(keys, f"search {seed}"))
    fit_in = tree_inputs(fit_df, numeric, categorical).where("_complete").withColumn(target, F.col(target).cast("double"))
    val_in = (tree_inputs(valid_df.where(F.col(target).isNotNull()), numeric, categorical).where("_complete")
              .withColumn(target, F.col(target).cast("double")))
    by = list(dict.fromkeys([*numeric, *categorical]))
    used = list(dict.fromkeys([*by, target]))
    fit_rows = _packed(fit_in.select(*used, "_hash"))
    val_rows = _packed(val_in.select(*used))
    enc = vector_pipeline(numeric, categorical).fit(fit_rows)
    cores = spark.sparkContext.defaultParallelism
    total = fit_rows.count()
    est = gbt_regressor(target, **(fixed or {}))
    trials = sample_params(n_trials, seed, space)
    left = dict(enumerate(trials))
    shares = [s for s in sorted(rungs) if s < 1.0 and total * s >= MIN_RUNG_ROWS] + [1.0]
    found: dict[int, tuple[float, float]] = {}
    for i, share in enumerate(shares):
        rows = fit_rows if share == 1.0 else _packed(fit_rows.where(F.col("_hash") < threshold(share)))
        partitions, limit, fit, free = _fitter(rows, val_rows, est, left, numeric, by, target, enc, executions, seed, set(fixed or {}) - {"seed"})
        # boosting is many small jobs: on a small sample a fit takes a core or two, and more fits run at once
        at_once = max(parallelism, cores // partitions) if limit is None else min(parallelism, limit)

        def run(job, fit=fit):
            p, e, group = job
            loss = fit(p, e)
            return [(t, loss[left[t]["maxIter"] - 1]) for t in group]

        scores: dict[int, list[float]] = {t: [] for t in left}
        with ThreadPool(max(1, at_once)) as pool:
            for part in pool.imap_unordered(inheritable_thread_target(run), _fits(left, executions)):
                for t, score in part:
                    scores[t].append(score)
        free()
        if rows is not fit_rows:
            rows.unpersist()
        found |= {t: (share, float(np.mean(s))) for t, s in scores.items()}
        best = sorted(left, key=lambda t: (found[t][1], t))
        left = {t: left[t] for t in best[:max(1, round(len(best) * keep))]}
    fit_rows.unpersist()
    val_rows.unpersist()
    order = sorted(found, key=lambda t: (-found[t][0], found[t][1], t))
    rows = [(t, json.dumps(trials[t], sort_keys=True), found[t][1], executions, found[t][0]) for t in order]
    table = local_table(spark, rows, "trial int, params string, val_mse double, executions int, share double")
    return table.orderBy(F.desc("share"), "val_mse", "trial"), trials[order[0]]


def refit_best(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
               best: dict, seed: int = 42):
    """M5: refit the winning parameter set on all training rows (fit + validation)."""
    return fit_gbt(train, numeric, categorical, target, seed=seed, **best)


def loss_history(model, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str) -> list[float]:
    """M6: the mean squared error of a fitted tree pipeline after each of its rounds, over complete rows."""
    rows = tree_inputs(df.where(F.col(target).isNotNull()), numeric, categorical).where("_complete")
    rows = rows.withColumn(target, F.col(target).cast("double"))
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    return _losses(model.stages[-1], rows.select("features", target))


# --- penalised least squares -------------------------------------------------

PENALTIES = (0.0, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)


def ridge_search(train: DataFrame, fm: FeatureModel, target: str, penalties: Sequence[float] = PENALTIES,
                 folds: int = 5, keys: Sequence[str] | None = None, seed: int = 42):
    """Cross-validated penalties of the least-squares model, from one pass over the rows.

    The model without a fold minimises (mean squared error + penalty * |w|^2) over the others'
    complete rows, the intercept unpenalised and the design standardised by ``fm``.  Rows enter a
    fold by the hash of ``keys``.  Returns (trial table: penalty, fold, n, mse), best penalty (lowest
    mean over the folds' rows; ties: the larger), and the ``LinearModel`` refitted on all rows with it.
    """
    if fm.target_mean is None:
        raise ValueError("FeatureModel was fitted without the target; pass target= to fit_features")
    keys = list(keys or train.columns)
    used = _complete_rows(train, fm, target)
    y = F.col(target).cast("double") - F.lit(fm.target_mean)
    fold = hash_u32(keys, f"fold {seed}") % folds
    parts = gram_by(used, fold, [F.lit(1.0)] + centred_design(fm, used) + [y])
    if not parts:
        raise ValueError("no complete training rows to fit")
    whole = sum(parts.values())
    rows, error = [], {}
    for penalty in penalties:
        total = 0.0
        for f, own in sorted(parts.items()):
            rest = whole - own
            if rest[0, 0] < 1:
                continue
            w = _coefficients(rest, penalty)
            # squared error on the fold: the residual is linear in [1, x..., y]
            sse = float(max(w @ own @ w, 0.0))
            rows.append((float(penalty), int(f), int(round(own[0, 0])), sse / own[0, 0]))
            total += sse
        error[penalty] = total
    best = min(penalties, key=lambda p: (error[p], -p))
    table = local_table(train.sparkSession, rows, "penalty double, fold int, n bigint, mse double")
    return table, best, _solve(whole, fm, fm.numeric, fm.categorical, penalty=best)


def _coefficients(g: np.ndarray, penalty: float) -> np.ndarray:
    """Vector v with v . [1, x..., y] = y - prediction, fitted from the Gram matrix ``g`` of [1, x..., y]."""
    from .models import penalised_solve

    n, sums = g[0, 0], g[0, 1:]
    cov = g[1:, 1:] - np.outer(sums, sums) / n
    w, _ = penalised_solve(cov[:-1, :-1], cov[:-1, -1], penalty * n)
    intercept = (sums[-1] - sums[:-1] @ w) / n
    return np.r_[-intercept, -w, 1.0]

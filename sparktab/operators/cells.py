"""Boosted trees over cells: rows of the same bins and levels summed before the fit.

A regression tree of Spark sees a numeric only by its bin (``maxBins`` of them, with thresholds from a
sample of the rows) and a node only by the count and the sum of the labels in each bin.  Rows of one cell,
that is of the same bin in every numeric and the same level in every categorical, always go the same way, and the
residual of squared loss falls by the same value in all of them.  So one pass that sums the labels of every cell
gives the trees that the rows would give, and boosting then works on cells: at most ``maxBins`` to the
number of numerics, times the levels, however many the rows.

A sampling rate below 1 draws rows, not cells: every round has its own draw, row by row with the seeds of
Spark's boosting, and the pass sums the drawn rows of every cell for every round.  What lies in a cell beyond its sums
(its inner squares) is the same for every split, and goes into the loss as it is.

The cells are worth it where they are far fewer than the rows (``MIN_ROWS_PER_CELL``); the caller fits the rows otherwise.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Sequence
from threading import Lock

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path

MIN_CELL_ROWS = 1_000_000  # fewer rows are fitted as they are: a round over cells takes more small jobs
MIN_ROWS_PER_CELL = 8
CELL_PARAMS = {"maxDepth", "maxIter", "stepSize", "subsamplingRate", "maxBins"}  # others may count rows of a node
FITS_AT_ONCE = 2         # the driver plans every round of a fit, and the heap follows the number of these
GC_SECONDS = 2.0
LINEAGE_ROUNDS = 10      # lineage is cut as often as in Spark's boosting


def cut_points(values: Sequence[float], max_bins: int) -> list[float]:
    """Thresholds between the sampled values, at most ``max_bins - 1``, chosen as Spark's trees choose theirs.

    Halfway between all neighbours if they are few enough, otherwise where the count of the values up to
    there is nearest to the next multiple of an even share.
    """
    counts = sorted(Counter(values).items())
    middle = [(a[0] + b[0]) / 2.0 for a, b in zip(counts, counts[1:])]
    splits = min(max_bins, len(values)) - 1
    if len(middle) <= splits:
        return middle
    stride = len(values) / (splits + 1)
    out, seen, goal = [], counts[0][1], stride
    for (_, n), cut in zip(counts[1:], middle):
        before, seen = seen, seen + n
        if abs(before - goal) < abs(seen - goal):
            out.append(cut)
            goal += stride
    return out


def sampled_cuts(rows: DataFrame, n: int, numeric: Sequence[str], max_bins: int, seed: int) -> dict[str, list[float]]:
    """``cut_points`` of every numeric, from as many rows as Spark's trees sample for theirs (all, if fewer)."""
    if not numeric:
        return {}
    want = max(max_bins * max_bins, 10_000)
    part = rows.select(*numeric)
    part = (part.sample(False, want / n, seed) if want < n else part).toPandas()
    return {c: cut_points(part[c].tolist(), max_bins) for c in numeric}


def _bin(col: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """Number of the cuts below ``col``, by halving."""
    if not cuts:
        return F.lit(float(first))
    mid = len(cuts) // 2
    return F.when(col <= F.lit(cuts[mid]), _bin(col, cuts[:mid], first)).otherwise(
        _bin(col, cuts[mid + 1:], first + mid + 1))


def binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """``rows`` with the bin of every numeric in its place (NaN stays, for the assembler to refuse)."""
    return rows.withColumns({c: F.when(F.isnan(c), F.col(c)).otherwise(_bin(F.col(c), t)) for c, t in cuts.items()})


def draw_sums(rows: DataFrame, by: Sequence[str], target: str, rates: Sequence[float], rounds: int, seed: int) -> DataFrame:
    """One row per cell: for every rate the count ``_n<i>`` and label sum ``_s<i>`` of the rows drawn in each round (arrays)."""
    below = [r for r in rates if r < 1.0]
    # the generator and seeds that Spark's boosting draws the rows of round m with
    drawn = rows.select(*by, target, *[F.rand(seed + m + 1).alias(f"_u{m}") for m in range(rounds) if below])
    aggs = [F.count(target).cast("double").alias("_n"), F.sum(target).alias("_s")]
    for i, rate in enumerate(rates):
        if rate < 1.0:
            taken = [F.col(f"_u{m}") < rate for m in range(rounds)]
            aggs += [F.sum(F.when(t, 1.0).otherwise(0.0)).alias(f"_n{i}_{m}") for m, t in enumerate(taken)]
            aggs += [F.sum(F.when(t, F.col(target)).otherwise(0.0)).alias(f"_s{i}_{m}") for m, t in enumerate(taken)]
    cells = drawn.groupBy(*by).agg(*aggs)
    out = []
    for i, rate in enumerate(rates):
        for name in ("_n", "_s"):
            each = F.array(*[f"{name}{i}_{m}" for m in range(rounds)]) if rate < 1.0 else F.array_repeat(name, rounds)
            out.append(each.alias(f"{name}{i}"))
    return cells.select(*by, *out)


def fit_cells(rows: DataFrame, valid: DataFrame, cuts: dict[str, list[float]], by: Sequence[str], target: str, encoder,
              rates: Sequence[float], rounds: int, seed: int) -> DataFrame:
    """The cells of the fit rows with their drawn sums, and those of the validation rows with count, mean and inner squares."""
    fit = draw_sums(binned(rows, cuts), by, target, rates, rounds, seed)
    val = binned(valid, cuts).groupBy(*by).agg(
        F.count(target).cast("double").alias("_vn"), F.avg(target).alias("_vm"),
        (F.var_pop(target) * F.count(target)).alias("_vss"))
    cells = encoder.transform(fit.unionByName(val, allowMissingColumns=True))
    drawn = [f"{name}{i}" for i in range(len(rates)) for name in ("_n", "_s")]
    return cells.select("features", *drawn, "_vn", "_vm", "_vss")


_collected, _collecting = [0.0], Lock()


def collect_garbage(spark) -> None:
    """Every ``GC_SECONDS`` at most: the driver's heap collected in full, which gives memory back.

    A round is some 20 small jobs.  What they leave behind is garbage at once, but a heap that is let grow takes all it may.
    """
    with _collecting:
        if (now := time.monotonic()) - _collected[0] < GC_SECONDS:
            return
        _collected[0] = now
    spark.sparkContext._jvm.System.gc()


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` as written under ``path``: a scan, with nothing of the plan that made it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def boosted_losses(cells: DataFrame, n_cells: int, rate_index: int, params: dict, seed: int) -> list[float]:
    """Mean squared validation error after each round of boosting over ``cells`` (of ``fit_cells``).

    The rounds are those of Spark's ``GBTRegressor`` with squared loss: the first tree fits the labels, each
    further one twice the residual, and enters with the step size.
    """
    from pyspark.ml.regression import DecisionTreeRegressor

    # bins are the features here: each is a candidate threshold, none of them to be sampled or merged away
    bins = max(params["maxBins"], int(np.ceil(np.sqrt(n_cells))) + 1)
    state = cells.select("features", "_vn", "_vm", "_vss", F.col(f"_n{rate_index}").alias("_n"),
                         F.col(f"_s{rate_index}").alias("_s"), F.lit(0.0).alias("_f"),
                         F.expr("cast(array() as array<double>)").alias("_loss"))
    written = []
    for m in range(params["maxIter"]):
        n, s = F.col("_n")[m], F.col("_s")[m]
        tree = DecisionTreeRegressor(labelCol="_label", weightCol="_weight", predictionCol="_tree", seed=seed + m,
                                     maxDepth=params["maxDepth"], maxBins=bins)
        gap = s / n - F.col("_f")
        # ``state`` is the table read last and the trees since: held tables over held tables would each tell the plan
        # of the one below twice, first and final, and so double the driver's memory in every round
        drawn = state.where(n > 0).select("features", (gap if m == 0 else 2 * gap).alias("_label"), n.alias("_weight")).persist()
        model = tree.fit(drawn)
        drawn.unpersist()
        collect_garbage(cells.sparkSession)
        moved = model.transform(state).withColumn("_f", F.col("_f") + F.col("_tree") * (1.0 if m == 0 else params["stepSize"]))
        loss = F.coalesce(F.col("_vss") + F.col("_vn") * F.pow(F.col("_vm") - F.col("_f"), 2), F.lit(0.0))
        state = moved.withColumn("_loss", F.concat("_loss", F.array(loss))).drop("_tree")
        if m % LINEAGE_ROUNDS == LINEAGE_ROUNDS - 1 and m + 1 < params["maxIter"]:
            written.append(scratch_path(cells.sparkSession, "cells"))
            state = stored(state, written[-1])
            if len(written) > 1:
                delete_path(cells.sparkSession, written[-2])
    sums = state.agg(F.sum("_vn"), *[F.sum(F.col("_loss")[m]) for m in range(params["maxIter"])]).first()
    for path in written[-1:]:
        delete_path(cells.sparkSession, path)
    return [x / sums[0] if sums[0] else float("nan") for x in sums[1:]]

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators.features import fit_features
from sparktab.operators.models import fit_gbt, fit_linear, gbt_regressor, gram_by, vector_pipeline
from sparktab.operators.roles import Roles
from sparktab.operators.search import _fits, loss_history, random_search, ridge_search

SCHEMA = "k int, a double, b double, c string, y double"


def made(spark, n=900, seed=0, nulls=True):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(3, 2), rng.normal(-1, 5), rng.choice(["x", "y", "z"])
        y = 2 * a - 0.3 * b + {"x": 1.0, "y": -2.0, "z": 0.0}[c] + rng.normal()
        rows.append((i, float(a), float(b), str(c), float(y)))
    if nulls:
        rows += [(n, None, 1.0, "x", 1.0), (n + 1, 1.0, 1.0, None, 2.0), (n + 2, 1.0, 1.0, "x", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_trials_that_differ_in_rounds_are_one_fit(spark):
    same = {"maxDepth": 2, "stepSize": 0.1, "subsamplingRate": 1.0}
    trials = {0: same | {"maxIter": 10}, 1: same | {"maxIter": 30}, 2: same | {"maxIter": 10, "maxDepth": 3}}
    fits = _fits(trials, 2)
    assert len(fits) == 4 and sorted(g for p, _, g in fits if p["maxIter"] == 30) == [[0, 1], [0, 1]]
    df = made(spark, 300, nulls=False)
    v = vector_pipeline(["a", "b"], []).fit(df).transform(df).select("features", "y").cache()
    est = gbt_regressor("y", maxDepth=2, seed=1, subsamplingRate=0.8)
    long = est.fit(v, {est.maxIter: 12}).evaluateEachIteration(v, "squared")
    short = est.fit(v, {est.maxIter: 5}).evaluateEachIteration(v, "squared")
    assert long[:5] == pytest.approx(short)  # the first rounds do not depend on those that follow


def test_halving_keeps_the_best_and_reports_all(spark, monkeypatch):
    from sparktab.operators import search

    monkeypatch.setattr(search, "MIN_RUNG_ROWS", 30)
    df = made(spark)
    fit, valid = df.where("k % 4 > 0"), df.where("k % 4 = 0")
    table, best = random_search(fit, valid, ["a", "b"], ["c"], "y", n_trials=6, executions=1, seed=2, keys=["k"])
    rows = table.collect()
    assert len(rows) == 6 and json.loads(rows[0].params) == best
    assert [r.share for r in rows] == sorted((r.share for r in rows), reverse=True)
    assert sum(r.share == 1.0 for r in rows) == 1 and sum(r.share > 0.2 for r in rows) == 2
    whole, _ = random_search(fit, valid, ["a", "b"], ["c"], "y", n_trials=3, executions=1, seed=2, keys=["k"], rungs=(1.0,))
    assert [r.share for r in whole.collect()] == [1.0] * 3


def test_ridge_equals_refitting_every_fold(spark):
    from sparktab.functions.hashing import hash_u32

    df = made(spark)
    fm = fit_features(df, Roles(["a", "b"], ["c"]), target="y")
    table, best, model = ridge_search(df, fm, "y", (0.0, 0.1, 5.0), 4, ["k"], 7)
    rows = df.where("y is not null and a is not null").withColumn("fold", hash_u32(["k"], "fold 7") % 4).toPandas()
    levels = fm.level_list("c")
    x = np.c_[(rows.a - fm.means["a"]) / fm.scale("a"), (rows.b - fm.means["b"]) / fm.scale("b"),
              *[(rows.c.fillna("nan") == lv).astype(float) for lv in levels]]
    y = rows.y.to_numpy()

    def solve(keep, penalty):
        xm, ym = x[keep].mean(axis=0), y[keep].mean()
        u = x[keep] - xm
        w = np.linalg.pinv(u.T @ u + penalty * keep.sum() * np.eye(x.shape[1]), rcond=1e-10) @ u.T @ (y[keep] - ym)
        return lambda z: ym + (z - xm) @ w

    got = {(r.penalty, r.fold): (r.n, r.mse) for r in table.collect()}
    error = {}
    for penalty in (0.0, 0.1, 5.0):
        for f in range(4):
            out = (rows.fold == f).to_numpy()
            e = y[out] - solve(~out, penalty)(x[out])
            assert got[penalty, f][0] == out.sum() and got[penalty, f][1] == pytest.approx((e ** 2).mean(), rel=1e-9)
            error[penalty] = error.get(penalty, 0) + (e ** 2).sum()
    assert best == min(error, key=error.get)
    want = solve(np.ones(len(y), bool), best)(x)
    pred = model.predict(df.where("y is not null and a is not null")).orderBy("k").select("k", "y_pred").toPandas()
    assert pred.y_pred.to_numpy() == pytest.approx(want[np.argsort(rows.k.to_numpy())], rel=1e-9)


def test_no_penalty_is_plain_least_squares(spark):
    df = made(spark)
    fm = fit_features(df, Roles(["a", "b"], ["c"]), target="y")
    _, _, model = ridge_search(df, fm, "y", (0.0,), 3, ["k"])
    plain = fit_linear(df, fm, "y")
    assert model.intercept == pytest.approx(plain.intercept) and model.rank == plain.rank
    with pytest.raises(ValueError):
        ridge_search(df.where("k < 0"), fm, "y")


def test_wide_groups_take_the_array_path(spark, monkeypatch):
    from sparktab.operators import models

    df = made(spark, nulls=False)
    cols = [F.col("a"), F.col("b"), F.lit(1.0)]
    narrow = gram_by(df, F.col("k") % 3, cols)
    monkeypatch.setattr(models, "JVM_GRAM_MAX_TERMS", 0)
    wide = gram_by(df, F.col("k") % 3, cols)
    assert narrow.keys() == wide.keys() and all(np.allclose(narrow[g], wide[g]) for g in narrow)


def test_loss_history_falls_on_the_training_side(spark):
    df = made(spark)
    model = fit_gbt(df, ["a", "b"], ["c"], "y", maxIter=8, maxDepth=3, seed=1)
    losses = loss_history(model, df, ["a", "b"], ["c"], "y")
    assert len(losses) == 8 and all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    from sparktab.operators.models import predict_tree
    scored = predict_tree(model, df, ["a", "b"], ["c"]).where("y is not null and y_pred is not null")
    assert losses[-1] == pytest.approx(scored.agg(F.avg(F.pow(F.col("y") - F.col("y_pred"), 2))).first()[0], rel=1e-9)


def test_large_partitions_are_dealt_anew(spark, monkeypatch):
    """A file of one row group is one partition, which one task read whole in every round."""
    from sparktab.operators import models

    monkeypatch.setattr(models, "ROWS_PER_PARTITION", 1_000)
    df = spark.range(10_000).coalesce(1)
    sized = models._sized(df)
    n, largest = models.partition_rows(sized)
    assert n == 10_000 and largest <= 2_000
    assert sorted(r.id for r in sized.collect()) == list(range(10_000))
    few = models._sized(spark.range(1_500).coalesce(1))
    assert models.partition_rows(few) == (1_500, 1_500)
    sized.unpersist()
    few.unpersist()


def test_many_rows_of_few_cells_are_summed_before_the_fits(spark, monkeypatch):
    """Every tree fit read all rows at each level of every round; now it reads a row per cell, with the same losses."""
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

    from sparktab.operators import cells

    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(12)), float(rng.integers(6)), str(rng.choice(["x", "y", "z"]))) for i in range(4_000)]
    df = spark.createDataFrame([(*r, r[1] ** 2 - 7 * r[2] + 20 * (r[3] == "x") + float(rng.normal())) for r in rows], SCHEMA).repartition(4)
    fit, valid = df.where("k % 4 > 0").persist(), df.where("k % 4 = 0").persist()
    space = {"maxDepth": [2, 3], "maxIter": [3, 12], "stepSize": [0.3], "subsamplingRate": [0.6, 1.0]}
    read = []
    for cls in (DecisionTreeRegressor, GBTRegressor):
        def spy(self, data, params=None, real=cls.fit):
            read.append(data.count())
            return real(self, data, params)
        monkeypatch.setattr(cls, "fit", spy)

    def losses():
        read.clear()
        table, _ = random_search(fit, valid, ["a", "b"], ["c"], "y", n_trials=5, executions=1, seed=2, keys=["k"], rungs=(1.0,),
                                 space=space)
        return [r.val_mse for r in table.orderBy("trial").collect()], max(read)

    by_row, most = losses()
    assert most == 3_000
    monkeypatch.setattr(cells, "MIN_CELL_ROWS", 1_000)
    by_cell, most = losses()
    assert most <= 12 * 6 * 3 and by_cell == pytest.approx(by_row, rel=1e-9)
    monkeypatch.setattr(cells, "MIN_ROWS_PER_CELL", 1_000)  # cells that are no fewer than the rows do not pay
    assert losses() == (by_row, 3_000)
    fit.unpersist()
    valid.unpersist()


def test_plans_of_the_rounds_over_cells_do_not_double(spark, monkeypatch):
    """Each round held a table over the one before; its plan told that one's twice, and the driver's heap ran full."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from sparktab.operators import cells

    rng = np.random.default_rng(3)
    rows = [(i, float(rng.integers(8)), float(rng.integers(4)), "x", float(rng.normal())) for i in range(2_000)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    lengths = []

    def spy(self, data, params=None, real=DecisionTreeRegressor.fit):
        lengths.append(len(data._jdf.queryExecution().toString()))
        return real(self, data, params)
    monkeypatch.setattr(DecisionTreeRegressor, "fit", spy)
    monkeypatch.setattr(cells, "MIN_CELL_ROWS", 100)
    space = {"maxDepth": [2], "maxIter": [12], "stepSize": [0.3], "subsamplingRate": [1.0]}
    random_search(df.where("k % 4 > 0"), df.where("k % 4 = 0"), ["a", "b"], ["c"], "y", n_trials=1, executions=1, seed=2, keys=["k"],
                  rungs=(1.0,), space=space)
    assert len(lengths) == 12 and max(lengths) < 20 * lengths[0] and lengths[11] < lengths[9]


def test_cut_points_are_those_of_the_trees():
    from sparktab.operators.cells import cut_points

    assert cut_points([3.0, 1.0, 1.0, 2.0], 32) == [1.5, 2.5] and cut_points([5.0, 5.0], 32) == []
    assert cut_points([1.0] * 2 + [2.0] * 2 + [3.0] * 2 + [4.0] * 2, 2) == [2.5]
    assert len(cut_points([float(x) for x in range(1_000)], 32)) == 31

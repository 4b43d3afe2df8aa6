from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators.ledger import Ledger
from sparktab.operators.model_tables import node_table, walk
from sparktab.operators.models import fit_gbt, predict_tree
from sparktab.plans.jobs import (JobSpec, run_feature_engineering, run_inference, run_training, run_tuning, load_feature_model,
                                 load_model)
from sparktab.operators.scoring import score_partial


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """A table, and linear and tree runs over different columns in one ledger."""
    root = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal(5, 2)), int(rng.integers(0, 9)), str(rng.choice(["a", "b", "c"])), bool(i % 3 == 0),
             float(rng.normal())) for i in range(400)]
    rows = [(*r[:5], 2 * r[1] - r[2] + {"a": 3, "b": 0, "c": -4}[r[3]] + r[4] + r[5]) for r in rows]
    df = spark.createDataFrame(rows, "k int, x double, n int, c string, flag boolean, y double")
    df.write.parquet(os.path.join(root, "data"))
    base = dict(data_path=os.path.join(root, "data"), target="y", ledger_root=os.path.join(root, "ledger"),
                index_column="k", data_format="parquet")
    specs = [JobSpec(**base), JobSpec(**base, exclude=("n", "flag")),
             JobSpec(**base, model_type="gbt", hyperparameters={"maxIter": 4, "maxDepth": 3, "seed": 1}),
             JobSpec(**base, exclude=("x",), model_type="gbt", hyperparameters={"maxIter": 2, "maxDepth": 4, "seed": 1})]
    runs = [run_training(spark, s, feature_run_id=run_feature_engineering(spark, s)) for s in specs]
    return specs[0], df, runs


def requests(spark, runs):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        rows.append((i, [*runs, None, "nope"][i % (len(runs) + 2)],
                     rng.choice(["1.5", "7", " ", "abc", "6.25"]) if i % 7 else None,
                     rng.choice(["3", "8"]) if i % 5 else None, str(rng.choice(["a", "b", "c", "zz"])) if i % 4 else None,
                     "True" if i % 2 else None))
    return spark.createDataFrame(rows, "id int, run string, x string, n string, c string, flag string")


def test_many_runs_equal_each_run_by_itself(spark, made):
    spec, _, runs = made
    req = requests(spark, runs)
    got = {r.id: r for r in run_inference(spark, spec, req, run_col="run", keep=["id"]).collect()}
    assert len(got) == 200
    ledger = Ledger(spark, spec.ledger_root)
    asked, seen = {r.id: r.x for r in req.collect()}, 0
    for run in runs:
        model, row = load_model(spark, ledger, run)
        fm = load_feature_model(spark, ledger, row["feature_run_id"])
        mine = req.where(F.col("run") == run) if run != runs[-1] else req.where((F.col("run") == run) | F.col("run").isNull())
        for r in score_partial(mine, fm, model, keep=["id"]).collect():
            g = got[r.id]
            assert g.model_run_id == run and g.model_type == row["model_type"]
            if asked[r.id] == "abc" and "x" in fm.numeric:
                assert (g.status, g.reason, g.y_pred) == ("bad_request", "not a number: x", None)
                continue
            assert g.status == "ok" and g.y_pred == pytest.approx(r.y_pred, rel=1e-12)
            assert g.imputed == r.imputed
            seen += 1
    assert seen > 100
    for r in got.values():
        if r.model_run_id == "nope":
            assert (r.status, r.reason, r.y_pred, r.imputed) == ("not_found", "Run nope not found", None, None)


def test_requests_are_scanned_once(spark, made, scratch, monkeypatch):
    from sparktab.operators import model_tables

    spec, _, runs = made
    path = os.path.join(scratch, "requests-in")
    requests(spark, runs).write.parquet(path)
    read = spark.read.parquet(path)
    # with tree runs the joined requests are written once, and the rest reads what was written
    out = run_inference(spark, spec, read, run_col="run", keep=["id"])
    assert out._jdf.queryExecution().executedPlan().toString().count("requests-in") == 0
    # without them the plan has one scan of the requests, whatever the number of runs
    monkeypatch.setattr(model_tables, "tree_nodes", lambda ledger: spark.createDataFrame([], model_tables.NODES))
    out = run_inference(spark, spec, read, run_col="run", keep=["id"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("given") and out.inputFiles() and sum("requests-in" in f for f in out.inputFiles()) >= 1
    scans = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "requests-in" in line]
    assert len(scans) == 1


def test_node_table_walks_like_the_model(spark, made, scratch):
    _, df, _ = made
    model = fit_gbt(df, ["x", "n"], ["c", "flag"], "y", maxIter=6, maxDepth=5, seed=2, subsamplingRate=0.7)
    path = os.path.join(scratch, "model")
    model.write().save(path)
    nodes = node_table(spark, "r", model, path, ["x", "n"], ["c", "flag"])
    odd = df.withColumn("c", F.when(F.col("k") % 5 == 0, F.lit("new")).otherwise(F.col("c")))
    want = {r.k: r.y_pred for r in predict_tree(model, odd, ["x", "n"], ["c", "flag"]).collect()}
    values = F.create_map(F.lit("x"), F.col("x").cast("string"), F.lit("n"), F.col("n").cast("string"), F.lit("c"), "c",
                          F.lit("flag"), F.initcap(F.col("flag").cast("string")))
    req = odd.select(F.col("k").cast("bigint").alias("rid"), F.lit("r").alias("run_id"), values.alias("values"))
    got = {r.rid: r.y_pred for r in walk(req, nodes).collect()}
    assert len(got) == 400 and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)
    assert walk(req, nodes.limit(0)).count() == 0


def test_no_ledger_runs_and_no_requests(spark, made, scratch):
    spec, _, runs = made
    assert run_inference(spark, spec, requests(spark, runs).limit(0), run_col="run", keep=["id"]).count() == 0
    out = run_inference(spark, spec, spark.createDataFrame([(1, "x")], "a int, b string")).first()
    assert out.status == "ok" and set(out.imputed) == {"n", "c", "flag"}


def test_tuning_job_refits_and_records(spark, made):
    spec, _, _ = made
    space = {"maxDepth": [1, 3], "maxIter": [2, 4], "stepSize": [0.1], "subsamplingRate": [1.0]}
    ids = run_tuning(spark, spec, n_trials=3, executions=1, validation=0.2, space=space, rungs=(1.0,))
    ledger = Ledger(spark, spec.ledger_root)
    import json
    trials = json.loads(ledger.artifact_text(ids["tuning"], "trials"))
    best = json.loads(trials[0]["params"])
    params = {r.key: r.value for r in ledger.params().where(F.col("run_id") == ids["training"]).collect()}
    assert params["model_maxDepth"] == str(best["maxDepth"]) and params["model_maxIter"] == str(best["maxIter"])
    loss = [r.value for r in ledger.metrics().where((F.col("run_id") == ids["training"]) & (F.col("key") == "train_loss"))
            .orderBy("step").collect()]
    assert len(loss) == best["maxIter"] and all(b <= a for a, b in zip(loss, loss[1:]))
    final = {(r.run_id, r.key): r.value for r in ledger.metrics().collect()}
    assert loss[-1] == pytest.approx(final[ids["training"], "train_loss_final"])
    assert final[ids["evaluation"], "eval_mse"] == pytest.approx(final[ids["training"], "mse"])
    assert ledger.run_row(ids["training"])["parent_id"] == ids["tuning"]


def test_small_models_need_no_shuffle_of_the_requests(spark, made, monkeypatch):
    """Requests are scored row by row; a group-by per request sorted all of them in as many tasks as there are partitions."""
    from sparktab.operators import model_tables

    spec, _, runs = made
    req = requests(spark, runs)
    got = sorted(map(str, run_inference(spark, spec, req, run_col="run", keep=["id"]).collect()))
    monkeypatch.setattr(model_tables, "ROW_ENTRIES", 0)  # by joins, as large models are
    assert sorted(map(str, run_inference(spark, spec, req, run_col="run", keep=["id"]).collect())) == got
    monkeypatch.undo()
    monkeypatch.setattr(model_tables, "tree_nodes", lambda ledger: spark.createDataFrame([], model_tables.NODES))
    plan = run_inference(spark, spec, req, run_col="run", keep=["id"])._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("given")]  # what lies above the requests
    assert "Aggregate" not in above and "rid" not in above

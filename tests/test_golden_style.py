"""The workflow on a table made in code, against numpy (runs without any recorded table)."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest

from sparktab.operators.ledger import Ledger
from sparktab.plans.jobs import JobSpec, run_offline_workflow


def test_workflow_equals_numpy(spark, scratch):
    rng = np.random.default_rng(12)
    n = 160
    area, rooms = rng.integers(500, 4000, n).astype(float), rng.integers(1, 6, n).astype(float)
    kind = np.array(["a", "b", "c"])[rng.integers(0, 3, n)]
    road = rng.integers(0, 2, n).astype(bool)
    price = 100 * area + 5000 * rooms + 30_000 * (kind == "b") - 9000 * road + rng.normal(0, 4000, n)
    rows = [(i, float(price[i]), float(area[i]), float(rooms[i]), str(kind[i]), bool(road[i])) for i in range(n)]
    data = os.path.join(scratch, "t.parquet")
    spark.createDataFrame(rows, "id long, price double, area double, rooms double, kind string, road boolean") \
        .write.parquet(data)
    spec = JobSpec(data, "price", os.path.join(scratch, "l"), index_column="id", seed=7)
    ids = run_offline_workflow(spark, spec)
    ledger = Ledger(spark, spec.ledger_root)
    pred = {r.id: r for r in spark.read.parquet(ledger.artifact_path(ids["evaluation"], "predictions")).collect()}
    assert len(pred) == 32  # ceil(160 * 0.2)
    test = np.isin(np.arange(n), list(pred))
    x = np.column_stack([np.ones(n), area, rooms, *[(kind == k).astype(float) for k in "abc"], road, ~road])
    w = np.linalg.lstsq(x[~test], price[~test], rcond=None)[0]
    want = x @ w
    for i, r in pred.items():
        assert r.y_pred == pytest.approx(want[i], rel=1e-9) and r.y_true == price[i]
        assert r.residual == pytest.approx(price[i] - want[i], abs=1e-4)
    e = price[test] - want[test]
    m = json.loads(ledger.artifact_text(ids["evaluation"], "metrics"))
    assert m["mae"] == pytest.approx(np.abs(e).mean()) and m["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert m["r2"] == pytest.approx(1 - (e ** 2).sum() / ((price[test] - price[test].mean()) ** 2).sum())
    stats = json.loads(ledger.artifact_text(ids["feature_engineering"], "feature_model"))
    assert stats["numeric_means"]["area"] == pytest.approx(area[~test].mean())
    assert stats["numeric_stds"]["area"] == pytest.approx(area[~test].std(ddof=1))
    assert stats["categorical_levels"]["kind"] == {k: int((kind[~test] == k).sum()) for k in "abc"}

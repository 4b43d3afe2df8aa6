from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from sparktab.sources.runstore import read_run_store, scan, write_run_store

SCHEMA = "run_id string, kind string, key string, line int, value string"


def rows(run, seed="7"):
    return [(run, "meta", "run_name", 0, "first: try"), (run, "meta", "status", 1, "3"), (run, "meta", "start_time", 2, "1700000000123"),
            (run, "meta", "end_time", 3, "null"), (run, "param", "random_state", 0, seed), (run, "param", "a key/with 100%/é", 0, "x\ny"),
            (run, "tag", "stage", 0, "training"), (run, "tag", "mlflow.parentRunId", 0, "p" * 32),
            (run, "metric", "val loss", 0, "1700000000123 0.5 0"), (run, "metric", "val loss", 1, "1700000000999 0.25 1")]


def test_keys_come_back_as_written(spark, scratch):
    ids = [f"{i:032x}" for i in range(7)]
    df = spark.createDataFrame([r for i in ids for r in rows(i, str(int(i, 16)))], SCHEMA).repartition(3)
    assert write_run_store(df, scratch, "exp") == 7 * 6
    assert write_run_store(df, scratch, "exp") == 7 * 6  # again: the same files
    os.makedirs(os.path.join(scratch, "exp", "notes"))   # no run
    open(os.path.join(scratch, "exp", ids[0], "other.txt"), "w").close()
    t = read_run_store(spark, scratch, runs_per_task=2)
    assert scan(spark, scratch, 2).rdd.getNumPartitions() == 4
    params = {(r.run_id, r.key): r.value for r in t["params"].collect()}
    assert params[ids[3], "a key/with 100%/é"] == "x\ny" and params[ids[3], "random_state"] == "3" and len(params) == 14
    m = t["metrics"].where(F.col("run_id") == ids[1]).orderBy("step").collect()
    assert [(r.key, r.value, r.step) for r in m] == [("val loss", 0.5, 0), ("val loss", 0.25, 1)]
    run = t["runs"].where(F.col("run_id") == ids[5]).first()
    assert (run["name"], run.status, run.stage, run.parent_id, run.split_seed) == ("first: try", "FINISHED", "training", "p" * 32, 5)
    assert run.start_ts is not None and run.end_ts is None and t["runs"].count() == 7
    assert {(r.experiment, r.kind) for r in scan(spark, scratch).select("experiment", "kind").distinct().collect()} == {
        ("exp", k) for k in ("meta", "param", "tag", "metric")}


def test_empty_store_and_bad_ids(spark, scratch):
    os.makedirs(os.path.join(scratch, "0"))
    t = read_run_store(spark, scratch)
    assert all(df.count() == 0 for df in t.values())
    with pytest.raises(ValueError):
        write_run_store(spark.createDataFrame(rows("not-hex"), SCHEMA), scratch)

"""Drift against stored profiles, one-pass validation, mergeable sketches and the request stream."""
from __future__ import annotations

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import checks, drift, profiles
from sparktab.operators.model_tables import score_requests
from sparktab.plans.jobs import JobSpec, run_feature_engineering, run_training
from sparktab.streaming import requests
from sparktab.streaming.sketches import merge_windows, rank_error, window_sketches


# --- profiles -------------------------------------------------------------------------------

def values(spark, seed=0, n=900):
    rng = np.random.default_rng(seed)
    rows = [(i, int(i % 3), float(rng.normal()), float(rng.integers(0, 5)) if i % 10 else None) for i in range(n)]
    return spark.createDataFrame(rows, "k int, part int, a double, b double").repartition(4)


def test_profile_gives_the_psi_of_both_sides(spark):
    df = values(spark)
    profile = profiles.build(df.where("part = 0"), ["a", "b"])
    got = {r.feature: r for r in profiles.compare(df.where("part > 0"), ["a", "b"], profile, []).collect()}
    for r in drift.psi(df, ["a", "b"], F.col("part") == 0).collect():
        assert got[r.feature].psi == pytest.approx(r.psi) and (got[r.feature].n_ref, got[r.feature].n_cur) == (r.n_ref, r.n_cur)
    for r in drift.ks(df, ["a", "b"], F.col("part") == 0).collect():
        assert got[r.feature].ks <= r.ks + 1e-12
    windows = profiles.compare(df.where("part > 0"), ["a"], profile, ["part"]).collect()
    assert sorted(r.part for r in windows) == [1, 2]


def test_profiles_merge(spark):
    df = values(spark)
    whole = profiles.build(df, ["a", "b"])
    edges = whole.select("feature", "edges")
    parts = [profiles.count(df.where(F.col("part") == p), ["a", "b"], edges) for p in range(3)]
    assert sorted(map(str, profiles.merge(*parts).collect())) == sorted(map(str, whole.collect()))
    other = profiles.build(df.where("k < 50"), ["a", "b"])
    with pytest.raises(Exception, match="different edges"):
        profiles.merge(whole, other).collect()


def test_profile_of_an_empty_side(spark):
    df = values(spark)
    profile = profiles.build(df, ["a"])
    assert profiles.compare(df.limit(0), ["a"], profile, ["part"]).count() == 0
    none = profiles.count(df.limit(0), ["a"], profile.select("feature", "edges")).first()
    assert none.n == 0 and set(none.counts) == {0}


# --- validation -------------------------------------------------------------------------------

RULES = [checks.Rule("k", "unique", "k"), checks.Rule("a", "range", "a", (-1.0, 1.0)), checks.Rule("b", "not_null", "b"),
         checks.Rule("part", "allowed", "part", (0, 1))]


@pytest.mark.parametrize("few", [True, False])
def test_validate_equals_report_and_quarantine(spark, scratch, monkeypatch, few):
    if not few:
        monkeypatch.setattr(checks, "MAX_BROADCAST_KEYS", 1)
    df = values(spark).withColumn("k", F.when(F.col("k") % 7 == 0, F.col("k") - 1).otherwise(F.col("k")))
    df = df.unionByName(df.limit(3).withColumn("k", F.lit(None).cast("int")))
    sink = os.path.join(scratch, "bad")
    report = checks.validate(df, RULES, sink)
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, checks.rule_report(df, RULES).collect()))
    got = spark.read.parquet(sink)
    assert got.columns == [*df.columns, "failed_rules"]
    assert sorted(map(str, got.collect())) == sorted(map(str, checks.quarantine(df, RULES).select(got.columns).collect()))


def test_validate_without_rules_or_rows(spark, scratch):
    df = values(spark)
    assert checks.validate(df, [], os.path.join(scratch, "a")).count() == 0
    report = checks.validate(df.limit(0), RULES, os.path.join(scratch, "b")).collect()
    assert [(r.checked, r.failed) for r in report] == [(0, 0)] * 4


# --- sketches ----------------------------------------------------------------------------------

def events(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(minutes=int(rng.integers(0, 60 * 24 * 20))), str(rng.choice(["x", "y"])),
             float(rng.gamma(2.0))) for _ in range(n)] + [(start, "x", None), (start, "x", float("nan"))]
    return spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double").repartition(3)


def test_merged_windows_are_exact_when_small_and_bounded_when_large(spark):
    df = events(spark, 3000)
    pdf = df.where("not isnan(value)").toPandas().dropna()
    for k in (4096, 200):
        days = window_sketches(df, k=k).cache()
        assert days.count() > 30
        for r in merge_windows(days, ["event_type"], [0.5, 0.95], k=k).collect():
            v = np.sort(pdf[pdf.event_type == r.event_type].value.to_numpy())
            assert r.n == len(v) and r["mean"] == pytest.approx(v.mean()) and r.greatest == v[-1]
            for p, got in ((0.5, r.p50), (0.95, r.p95)):
                if len(v) <= k:
                    assert got == v[int(np.ceil(p * len(v))) - 1]
                else:
                    assert abs(np.searchsorted(v, got, "right") / len(v) - p) <= 2 * rank_error(k)
    assert rank_error(200) == pytest.approx(0.0133, abs=2e-4)


# --- the request stream ---------------------------------------------------------------------------

@pytest.fixture()
def fitted(spark, scratch):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(float(x), str(rng.choice(["a", "b"])), float(2 * x + 1)) for x in rng.normal(size=60)],
                               "x double, c string, y double")
    df.write.parquet(os.path.join(scratch, "data"))
    spec = JobSpec(os.path.join(scratch, "data"), "y", os.path.join(scratch, "ledger"), data_format="parquet")
    run = run_training(spark, spec, feature_run_id=run_feature_engineering(spark, spec))
    rows = [(i, [run, None, "nope"][i % 3], ["1.5", None, "much"][i % 4 % 3], "a" if i % 5 else None) for i in range(60)]
    req = spark.createDataFrame(rows, "id int, run string, x string, c string")
    req.repartition(4, "id").write.parquet(os.path.join(scratch, "requests"))
    return spec, req


def test_stream_equals_batch_and_restarts_without_doubles(spark, scratch, fitted, monkeypatch):
    from sparktab.operators.ledger import Ledger

    spec, req = fitted
    where = dict(sink=os.path.join(scratch, "out"), checkpoint=os.path.join(scratch, "ckpt"), max_files_per_trigger=1,
                 run_col="run", keep=["id"])
    args = (spark, spec.ledger_root, os.path.join(scratch, "requests"), req.schema)
    plain, calls = requests.score_batch, []

    def crash(batch, i, *rest):
        calls.append(i)
        if len(calls) == 3:  # after the rows, before the log
            monkeypatch.setattr(requests, "score_batch", plain)
            batch.select("id").withColumn("side", F.lit("scored")).write.partitionBy("side").parquet(f"{where['sink']}/batch={i}")
            raise RuntimeError("executor lost")
        plain(batch, i, *rest)

    monkeypatch.setattr(requests, "score_batch", crash)
    with pytest.raises(Exception, match="executor lost"):
        requests.score_request_stream(*args, **where)
    done, log = requests.read_batches(spark, where["sink"])
    assert log.count() == 2 and done.count() == log.agg(F.sum(F.col("scored") + F.col("rejects"))).first()[0]
    rows, log = requests.score_request_stream(*args, **where)
    ledger = Ledger(spark, spec.ledger_root)
    default = F.lit(ledger.latest_run("training")["run_id"])
    want = score_requests(req, F.coalesce(F.col("run"), default), ledger, ["id"])
    cols = ["id", "model_run_id", "status", "reason", "used_features", "y_pred"]
    assert sorted(map(str, rows.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert log.count() >= 4 and rows.count() == 60
    assert rows.where("side = 'scored'").count() == rows.where("status = 'ok'").count() > 0
    again, log2 = requests.score_request_stream(*args, **where)  # nothing new
    assert again.count() == 60 and log2.count() == log.count()

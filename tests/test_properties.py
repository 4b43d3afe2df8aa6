"""Property tests against brute force on small random tables, and batch = stream parity."""

from __future__ import annotations

import os

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparktab.operators.features import fit_features
from sparktab.operators.models import fit_linear
from sparktab.operators.roles import Roles
from sparktab.operators.split import hash_split, stratified_split
from sparktab.plans.jobs import JobSpec, load
from sparktab.streaming.scoring import score_stream_to_table

rows_strategy = st.lists(
    st.tuples(st.integers(-50, 50), st.integers(0, 3), st.sampled_from(["a", "b", "c"]),
              st.sampled_from(["x", "y"]), st.integers(-1000, 1000)),
    min_size=2, max_size=25)


def _brute_force(rows, cats_a, cats_b):
    """Reference semantics: standardise (population std), full one-hot, OLS with intercept, min norm."""
    x1 = np.array([r[0] for r in rows], float)
    x2 = np.array([r[1] for r in rows], float)
    y = np.array([r[4] for r in rows], float)
    cols = []
    for x in (x1, x2):
        s = x.std()
        cols.append((x - x.mean()) / (s if s > 0 else 1.0))
    for idx, levels in ((2, cats_a), (3, cats_b)):
        for lv in levels:
            cols.append(np.array([1.0 if r[idx] == lv else 0.0 for r in rows]))
    X = np.column_stack(cols)
    xm, ym = X.mean(axis=0), y.mean()
    w, *_ = np.linalg.lstsq(X - xm, y - ym, rcond=None)
    return X @ w + (ym - xm @ w)


@settings(max_examples=15, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_least_squares_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "x1 long, x2 long, a string, b string, y long")
    fm = fit_features(df, Roles(["x1", "x2"], ["a", "b"]), target="y")
    lm = fit_linear(df, fm, "y")
    got = np.array([r.p for r in df.select(lm.predict_col(df).alias("p")).collect()])
    want = _brute_force(rows, sorted({r[2] for r in rows}), sorted({r[3] for r in rows}))
    scale = max(1.0, float(np.abs(want).max()))
    assert np.allclose(got, want, atol=1e-6 * scale)


@settings(max_examples=10, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(0, 10_000), min_size=1, max_size=200), frac=st.floats(0.05, 0.95))
def test_split_partitions_rows(spark, keys, frac):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    s = hash_split(df, ["k"], frac, 11)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == len(keys)  # train ∪ test = all, disjoint by construction


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 100_000), st.sampled_from(["p", "q", "r"])),
                     min_size=1, max_size=120, unique_by=lambda r: r[0]),
       frac=st.floats(0.05, 0.9))
def test_stratified_split_brute_force(spark, rows, frac):
    import hashlib
    import math

    df = spark.createDataFrame(rows, "k long, g string")
    got = {(r.k, r.split) for r in stratified_split(df, ["k"], "g", frac, 5).select("k", "split").collect()}
    want = set()
    for g in {r[1] for r in rows}:
        hs = sorted((int(hashlib.md5(f"5|{k}".encode()).hexdigest()[:8], 16), k) for k, gg in rows if gg == g)
        need = math.ceil(len(hs) * frac)
        cut = hs[need - 1][0]
        want |= {(k, "test" if h <= cut else "train") for h, k in hs}
    assert got == want


def test_batch_equals_stream(spark, scratch):
    sf = "/root/testdata/sf0.001"
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    tr = hash_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42).where(F.col("split") == "train")
    fm = fit_features(tr, Roles(["l_quantity", "l_discount"], ["l_returnflag"]), target="l_extendedprice")
    lm = fit_linear(tr, fm, "l_extendedprice")
    keys = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    batch = li.select(*keys, lm.predict_col(li).alias("y_pred"))
    stream = score_stream_to_table(spark, f"{sf}/lineitem*.parquet", li.schema, lm, keep=keys,
                                   sink=os.path.join(scratch, "out"), checkpoint=os.path.join(scratch, "ck"))
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_missing_target_and_bad_numeric(spark, scratch):
    p = os.path.join(scratch, "t.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    with pytest.raises(KeyError):
        load(spark, JobSpec(p, "price", scratch))
    one = spark.createDataFrame([(5.0, "a", 1.0)], "x double, g string, y double")
    fm = fit_features(one, Roles(["x"], ["g"]), target="y")
    assert fm.stds["x"] == 0.0 and fm.std_pop["x"] == 0.0  # single row: std 0
    lm = fit_linear(one, fm, "y")
    assert one.select(lm.predict_col(one)).first()[0] == pytest.approx(1.0)


def test_stream_partial_records_are_imputed(spark, scratch):
    import json

    src = os.path.join(scratch, "requests")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.json"), "w") as f:
        for rec in [{"id": 1, "x": 2.0, "g": "a"}, {"id": 2, "g": "b"}, {"id": 3, "x": 4.0}]:
            f.write(json.dumps(rec) + "\n")
    train = spark.createDataFrame([(1.0, "a", 10.0), (2.0, "b", 20.0), (3.0, "a", 30.0), (4.0, "b", 41.0)],
                                  "x double, g string, y double")
    fm = fit_features(train, Roles(["x"], ["g"]), target="y")
    lm = fit_linear(train, fm, "y")
    out = score_stream_to_table(spark, src, "id long, x double, g string", lm, keep=["id"], features=fm,
                                sink=os.path.join(scratch, "o"), checkpoint=os.path.join(scratch, "c"), fmt="json")
    got = {r.id: r for r in out.collect()}
    assert got[1].imputed == {} and got[2].imputed == {"x": "2.5"} and got[3].imputed == {"g": "b"}
    batch = train.select(lm.predict_col(train).alias("p")).collect()
    assert got[1].y_pred == pytest.approx(lm.predict(spark.createDataFrame([(2.0, "a")], "x double, g string")).first().y_pred)
    assert len(batch) == 4


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.integers(0, 30), min_size=1, max_size=80), b=st.lists(st.integers(0, 30), min_size=1, max_size=80))
def test_drift_statistics_brute_force(spark, a, b):
    from sparktab.operators import drift

    df = spark.createDataFrame([(float(v), True) for v in a] + [(float(v), False) for v in b], "v double, ref boolean")
    xa, xb = np.array(a, float), np.array(b, float)
    grid = np.union1d(xa, xb)
    ks_want = max(abs((xa <= g).mean() - (xb <= g).mean()) for g in grid)
    got = drift.ks(df, ["v"], F.col("ref")).first()
    assert got.ks == pytest.approx(ks_want, abs=1e-12) and (got.n_ref, got.n_cur) == (len(a), len(b))
    ranged = drift.ks(df, ["v"], F.col("ref"), max_distinct=0).first().ks
    assert ranged == pytest.approx(ks_want, abs=1e-12)
    edges = np.quantile(xa, [i / 10 for i in range(1, 10)])  # linear interpolation, like quantile_cont
    bins_a = (xa[:, None] > edges[None, :]).sum(1)
    bins_b = (xb[:, None] > edges[None, :]).sum(1)
    psi_want = 0.0
    for k in set(bins_a) | set(bins_b):
        p = max((bins_a == k).mean(), 1e-6)
        q = max((bins_b == k).mean(), 1e-6)
        psi_want += (q - p) * np.log(q / p)
    assert drift.psi(df, ["v"], F.col("ref")).first().psi == pytest.approx(psi_want, rel=1e-9, abs=1e-12)


def test_kafka_source_is_gated(spark):
    from sparktab.streaming.scoring import read_stream

    with pytest.raises(RuntimeError, match="connector"):
        read_stream(spark, "requests", "id long", fmt="kafka", **{"kafka.bootstrap.servers": "unused:9092"})


@settings(max_examples=8, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.integers(0, 1_000_000), min_size=1, max_size=150), frac=st.floats(0.05, 0.95))
def test_exact_split_brute_force(spark, keys, frac):
    import hashlib
    import math

    from sparktab.operators.split import exact_split

    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = sorted((r.k, r.split) for r in exact_split(df, ["k"], frac, 9).collect())
    hs = sorted((int(hashlib.md5(f"9|{k}".encode()).hexdigest()[:8], 16), k) for k in keys)
    cut = hs[math.ceil(len(hs) * frac) - 1][0]
    assert got == sorted((k, "test" if h <= cut else "train") for h, k in hs)


def test_materialized_split_prunes_partitions(spark, scratch):
    from sparktab.operators.split import materialize_split

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    s = materialize_split(hash_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42), os.path.join(scratch, "split"))
    test_rows = s.where(F.col("split") == "test")
    plan = test_rows._sc._jvm.PythonSQLUtils.explainString(test_rows._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(split" in plan and "(split#" in plan
    assert test_rows.count() == hash_split(li, ["l_orderkey", "l_linenumber"], 0.2, 42).where("split = 'test'").count()

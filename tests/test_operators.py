"""Unit expectations from the reference's tests plus the edge cases of FIXTURES.md §4."""

from __future__ import annotations

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import checks, drift, profile, stats
from sparktab.operators.features import align_records, fit_features, impute, is_missing
from sparktab.operators.metrics import regression_metrics, rmsle
from sparktab.operators.models import fit_linear, min_norm_solve
from sparktab.operators.quantiles import quantiles
from sparktab.operators.roles import Roles, infer_roles
from sparktab.operators.scoring import compare_runs, score_partial, score_pinned
from sparktab.operators.split import hash_split, manifest_split, stratified_split
from sparktab.sources.tables import read_csv, read_records


def test_roles_bool_is_categorical(spark):
    df = spark.createDataFrame([(1000, 3, "yes", True), (1200, 4, "no", False)],
                               "area long, bedrooms long, mainroad string, has_pool boolean")
    r = infer_roles(df)
    assert r.numeric == ["area", "bedrooms"]
    assert r.categorical == ["mainroad", "has_pool"]


def test_roles_report_dropped_types(spark):
    df = spark.sql("select 1 as a, 'x' as b, timestamp'2024-01-01 00:00:00' as t")
    r = infer_roles(df)
    assert r.dropped == [("t", "timestamp")]
    with pytest.raises(ValueError):
        infer_roles(df.select("t"))


def test_encoding_width(spark):
    df = spark.createDataFrame([(1000, 3, "yes"), (1200, 4, "no")], "area long, bedrooms long, mainroad string")
    fm = fit_features(df, infer_roles(df))
    assert fm.feature_names == ["numeric__area", "numeric__bedrooms", "categorical__mainroad_no",
                                "categorical__mainroad_yes"]
    assert len(fm.transform(df).columns) == 4


def test_training_stats_keys(spark):
    df = spark.createDataFrame([(1000, 3, "yes"), (1200, 4, "no")], "area long, bedrooms long, mainroad string")
    fm = fit_features(df, infer_roles(df))
    assert set(fm.means) == {"area", "bedrooms"} and "mainroad" in fm.levels


def test_metrics_fixture(spark):
    df = spark.createDataFrame([(3.0, 2.5), (5.0, 5.5), (7.0, 7.5)], "y_true double, y_pred double")
    m = regression_metrics(df).first()
    assert (m.mae, m.mse, m.rmse) == pytest.approx((0.5, 0.25, 0.5))
    assert m.r2 == pytest.approx(0.90625)


def test_metrics_edges(spark):
    one = spark.createDataFrame([(3.0, 2.0)], "y_true double, y_pred double")
    assert regression_metrics(one).first().r2 is None
    const = spark.createDataFrame([(3.0, 3.0), (3.0, 3.0)], "y_true double, y_pred double")
    assert regression_metrics(const).first().r2 == 1.0
    const2 = spark.createDataFrame([(3.0, 2.0), (3.0, 3.0)], "y_true double, y_pred double")
    assert regression_metrics(const2).first().r2 == 0.0
    neg = spark.createDataFrame([(-1.0, 2.0), (3.0, 3.0)], "y_true double, y_pred double")
    r = rmsle(neg).first()
    assert r.rmsle is None and r.n_negative == 1


def test_alignment_orders_and_rejects(spark):
    rec = spark.createDataFrame([({"bedrooms": "3", "area": "1000", "mainroad": "yes", "extra": "x"},),
                                 ({"area": "1000"},), ({"area": "abc", "bedrooms": "2", "mainroad": None},)],
                                "features map<string,string>")
    ok, rej = align_records(rec, "features", ["area", "bedrooms"], ["mainroad"])
    assert ok.columns == ["area", "bedrooms", "mainroad"]
    assert ok.collect() == [(1000.0, 3.0, "yes")]
    bad = sorted((r.missing, r.bad_cast) for r in rej.collect())
    assert bad == [([], ["area"]), (["bedrooms", "mainroad"], [])]


def test_missing_predicate(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("\t",), ("\n \u00a0",), ("x",)], "v string")
    assert [r[0] for r in df.select(is_missing(F.col("v"))).collect()] == [True] * 5 + [False]
    nan = spark.sql("select double('NaN') as v")
    assert nan.select(is_missing(F.col("v"))).first()[0] is False


def test_level_keys_null_bool_and_ties(spark):
    df = spark.createDataFrame([("a", True), ("b", False), (None, True), ("b", None), ("a", True)],
                               "c string, flag boolean")
    lc = {(r.feature, r.level): r.n for r in stats.level_counts(df, ["c", "flag"]).collect()}
    assert lc[("c", "nan")] == 1 and lc[("flag", "True")] == 3 and lc[("flag", "nan")] == 1
    modes = {r.feature: r.mode for r in stats.mode_levels(stats.level_counts(df, ["c"])).collect()}
    assert modes["c"] == "b"  # a/b tie at 2 -> lexicographically largest


def test_all_null_and_zero_variance(spark):
    df = spark.createDataFrame([(None, 5.0, 1.0), (None, 5.0, 2.0), (None, 5.0, 4.0)], "a double, b double, y double")
    fm = fit_features(df, Roles(["a", "b"], []), target="y")
    assert fm.means["a"] == 0 and fm.stds["a"] == 0 and fm.std_pop["b"] == 0
    z = df.select(fm.standardized("b").alias("z")).collect()
    assert all(r.z == 0.0 for r in z)


def test_rank_deficient_least_squares(spark):
    rows = [(100000 + 20000 * i, 1000 + 100 * i, [3, 3, 4, 4, 5][i], ["yes", "no"][i % 2], "no") for i in range(5)]
    df = spark.createDataFrame(rows, "price long, area long, bedrooms long, mainroad string, guestroom string")
    fm = fit_features(df, infer_roles(df, exclude=["price"]), target="price")
    lm = fit_linear(df, fm, "price")
    pred = lm.predict(df).select("price", "y_pred").collect()
    for r in pred:  # price is exactly linear in area
        assert r.y_pred == pytest.approx(r.price, rel=1e-9)
    # constant categorical: its single level gets weight 0 in the minimum-norm solution
    assert dict(lm.categorical)["guestroom"] == [("no", 0.0)] or abs(dict(lm.categorical)["guestroom"][0][1]) < 1e-6


def test_min_norm_solve_matches_pinv():
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 4))
    x = np.hstack([x, x[:, :1] + x[:, 1:2]])  # collinear column
    y = rng.normal(size=20)
    w, rank = min_norm_solve(x.T @ x, x.T @ y)
    assert rank == 4
    assert np.allclose(w, np.linalg.pinv(x) @ y, atol=1e-10)


def test_split_stable_under_repartition(spark):
    li = spark.read.parquet(f"{os.environ.get('SF', '/root/testdata/sf0.001')}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    base = sorted(hash_split(li, keys, 0.2, 42).groupBy("split").count().collect())
    for n in (1, 7, 64):
        again = sorted(hash_split(li.repartition(n), keys, 0.2, 42).groupBy("split").count().collect())
        assert again == base
    total = li.count()
    assert sum(r["count"] for r in base) == total


def test_duplicate_keys_share_a_side(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)] * 10, "k long, v double")
    sides = hash_split(df, ["k"], 0.5, 7).groupBy("k").agg(F.countDistinct("split").alias("d")).collect()
    assert all(r.d == 1 for r in sides)


def test_stratified_split_exact(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    s = stratified_split(li, ["l_orderkey", "l_linenumber"], "l_returnflag", 0.2, 42)
    got = {(r.l_returnflag, r.split): r["count"] for r in s.groupBy("l_returnflag", "split").count().collect()}
    n = {r.l_returnflag: r["count"] for r in li.groupBy("l_returnflag").count().collect()}
    import math
    for g, total in n.items():
        assert got[(g, "test")] >= math.ceil(total * 0.2)  # ties with the cut hash go to test
        assert got[(g, "test")] + got[(g, "train")] == total


def test_csv_na_tokens_and_types(spark, scratch):
    p = os.path.join(scratch, "t.csv")
    with open(p, "w") as f:
        f.write("a,b,c,d,e\n1,NA,True,x,2.5\n2,nan,False,,null\n3,7,True,  ,1\n")
    df = read_csv(spark, p)
    types = dict(df.dtypes)
    assert types == {"a": "int", "b": "int", "c": "boolean", "d": "string", "e": "double"}
    rows = df.orderBy("a").collect()
    assert rows[0].b is None and rows[1].b is None and rows[1].d is None and rows[1].e is None
    assert rows[2].d == "  "
    with pytest.raises(FileNotFoundError):
        read_csv(spark, os.path.join(scratch, "missing.csv"))


def test_json_records(spark, scratch):
    p = os.path.join(scratch, "r.json")
    with open(p, "w") as f:
        f.write('{"area": 7500, "bedrooms": 3, "mainroad": "yes"}\n{"area": 10}\n')
    rec = read_records(spark, p)
    rows = rec.collect()
    assert rows[0].features["area"] == "7500" and "bedrooms" not in rows[1].features


def test_score_partial_and_pinned(spark):
    df = spark.createDataFrame([(1.0, "a", 10.0), (2.0, "b", 20.0), (3.0, "a", 30.0), (4.0, "b", 41.0)],
                               "x double, g string, y double")
    fm = fit_features(df, Roles(["x"], ["g"]), target="y")
    lm = fit_linear(df, fm, "y")
    req = spark.createDataFrame([(1, None, "a"), (2, 2.0, None)], "id int, x double, g string")
    out = {r.id: r for r in score_partial(req, fm, lm, keep=["id"]).collect()}
    assert out[1].imputed == {"x": "2.5"} and out[2].imputed == {"g": "b"}
    full = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b")], "id int, x double, g string")
    pinned = score_pinned(full.withColumn("run", F.when(F.col("id") == 1, "m1").otherwise("zz")), "run", {"m1": lm})
    st = {r.id: (r.status, r.y_pred is None) for r in pinned.collect()}
    assert st == {1: ("ok", False), 2: ("not_found", True)}
    cmp = compare_runs(df, "y", {"m1": lm, "m2": lm}).collect()
    assert len(cmp) == 2 and cmp[0].mae == pytest.approx(cmp[1].mae)


def test_impute_mean_and_mode(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b"), (5.0, None)], "x double, g string")
    fm = fit_features(df, Roles(["x"], ["g"]))
    out = impute(df, fm).collect()
    assert out[2].x == pytest.approx(3.0) and out[3].g == "a"


def test_rule_report_and_quarantine(spark):
    df = spark.createDataFrame([(1, 5.0, "F"), (1, 50.0, "X"), (None, 7.0, "O")], "k long, v double, s string")
    rules = [checks.Rule("k.not_null", "not_null", "k"), checks.Rule("k.unique", "unique", "k"),
             checks.Rule("v.range", "range", "v", (0, 10)), checks.Rule("s.allowed", "allowed", "s", ("F", "O"))]
    rep = {r.rule: (r.checked, r.failed) for r in checks.rule_report(df, rules).collect()}
    assert rep == {"k.not_null": (3, 1), "k.unique": (2, 2), "v.range": (3, 1), "s.allowed": (3, 1)}
    # the null key, and both rows of the repeated one
    assert checks.quarantine(df, rules).count() == 3


def test_drift_identical_halves_are_zero(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("double").alias("v"), ((F.col("id") / 100).cast("int") % 2 == 0).alias("ref"))
    assert drift.ks(df, ["v"], F.col("ref")).first().ks == pytest.approx(0.0, abs=0.02)
    assert drift.psi(df, ["v"], F.col("ref")).first().psi == pytest.approx(0.0, abs=0.01)


def test_quantiles_exact_vs_approx(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    from sparktab.operators.quantiles import quantiles
    ex = quantiles(df, "v", [0.25, 0.5], exact=True).first().q
    ap = quantiles(df, "v", [0.25, 0.5], exact=False).first().q
    assert ex == [250.0, 500.0] and ap == pytest.approx([250.0, 500.0], abs=1.0)


def test_profile_shapes(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    assert profile.dataset_summary(o).first().n_columns == 6
    assert profile.null_counts(o).count() == 6
    s, out = profile.box_stats(o, "o_totalprice", "o_orderpriority")
    assert s.count() == 5
    assert profile.density(o, "o_totalprice", 20, 50).count() == 50


def test_bracket_quantiles_equal_exact(spark):
    import numpy as np
    from sparktab.operators.quantiles import bracket_quantiles, quantiles

    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=3000).round(2), np.full(2000, 0.5), rng.integers(0, 5, 500)])
    groups = rng.choice(["a", "b", "c"], size=len(vals), p=[0.6, 0.3, 0.1])
    df = spark.createDataFrame([(str(g), float(v)) for g, v in zip(groups, vals)], "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    exact = {r.g: r.q for r in quantiles(df, "v", probs, by=["g"], exact=True).collect()}
    for acc in (20, 1000):  # coarse sketch -> wide brackets / retries; fine sketch -> tight ones
        br = {r.g: r.q for r in bracket_quantiles(df, "v", probs, by=["g"], accuracy=acc).collect()}
        assert br.keys() == exact.keys()
        for g in exact:
            assert br[g] == pytest.approx(exact[g], rel=1e-12, abs=1e-12)
    one = bracket_quantiles(df, "v", [0.5], accuracy=50).first().q
    assert one == pytest.approx(quantiles(df, "v", [0.5], exact=True).first().q)


def test_nested_models_from_one_pass_equal_separate_fits(spark):
    from sparktab.operators.models import fit_linear_nested

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    fm = fit_features(li, Roles(["l_quantity", "l_discount"], ["l_returnflag", "l_linestatus"]),
                      target="l_extendedprice")
    runs = fit_linear_nested(li, fm, "l_extendedprice", {"full": (fm.numeric, fm.categorical),
                                                          "small": (["l_quantity"], ["l_linestatus"])})
    sep_full = fit_linear(li, fm, "l_extendedprice")
    fm_small = fit_features(li, Roles(["l_quantity"], ["l_linestatus"]), target="l_extendedprice")
    sep_small = fit_linear(li, fm_small, "l_extendedprice")
    got = li.select(runs["full"].predict_col(li).alias("a"), sep_full.predict_col(li).alias("b"),
                    runs["small"].predict_col(li).alias("c"), sep_small.predict_col(li).alias("d")).collect()
    for r in got:
        assert r.a == pytest.approx(r.b, rel=1e-9) and r.c == pytest.approx(r.d, rel=1e-9)


def test_boolean_categorical_impute_and_score(spark):
    df = spark.createDataFrame([(1.0, True, 10.0), (2.0, False, 20.0), (3.0, True, 31.0), (4.0, None, 40.0)],
                               "x double, flag boolean, y double")
    fm = fit_features(df, infer_roles(df, exclude=["y"]), target="y")
    assert set(fm.levels["flag"]) == {"True", "False", "nan"} and fm.fill["flag"] == "True"
    lm = fit_linear(df, fm, "y")
    req = spark.createDataFrame([(1.0, True), (1.0, None)], "x double, flag boolean")
    out = score_partial(req, fm, lm).collect()
    assert out[1].imputed == {"flag": "True"}
    assert out[0].y_pred == pytest.approx(out[1].y_pred)  # imputed True scores like an explicit True


def test_ks_ranged_path_equals_window_path(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    is_ref = F.col("l_shipdate") < F.lit("1998-06-01").cast("timestamp_ntz")
    cols = ["l_extendedprice", "l_quantity", "l_discount"]
    small = {r.feature: r for r in drift.ks(li, cols, is_ref).collect()}
    big = {r.feature: r for r in drift.ks(li, cols, is_ref, max_distinct=0).collect()}
    for f in cols:
        assert big[f].ks == pytest.approx(small[f].ks, abs=1e-12)
        assert (big[f].n_ref, big[f].n_cur) == (small[f].n_ref, small[f].n_cur)


def test_describe_keeps_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (4.0, None)], "a double, b double")
    rows = {r.feature: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert rows["b"]["count"] == 0 and rows["b"].q50 is None
    assert rows["a"].q50 == 2.0 and rows["a"].q25 == 1.5 and rows["a"]["count"] == 3


def test_drift_and_density_edges(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (3.0, True)], "v double, ref boolean")
    assert drift.ks(df, ["v"], F.col("ref")).first().ks is None  # no current rows
    assert drift.psi(df, ["v"], F.col("ref")).count() == 1
    const = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    d = profile.density(const, "v", 10, 20).collect()
    assert len(d) == 20 and all(r.density is None for r in d)


def test_summary_and_nulls_equal_separate_operators(spark):
    o = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    o = o.withColumn("o_comment", F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.lit("x")))
    summary, nulls = profile.summary_and_nulls(o)
    s = profile.dataset_summary(o).first()
    assert (summary["n_rows"], summary["n_columns"], summary["memory_mb"]) == (s.n_rows, s.n_columns, s.memory_mb)
    assert nulls == {r.column_name: r.nulls for r in profile.null_counts(o).collect()}


def test_correlation_matrix_path_equals_pairs(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    a = {(r.a, r.b): r.r for r in profile.correlation_long(li, cols, method="pairs").collect()}
    b = {(r.a, r.b): r.r for r in profile.correlation_long(li, cols, method="gram").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert b[k] == pytest.approx(a[k], abs=1e-9)


def test_correlation_of_40_columns_with_nulls(spark):
    """Pairwise-complete at every width, by both paths and numpy."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 40)) + rng.normal(size=(200, 1)) + 1000
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 39] = 5.0
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x],
                               ", ".join(f"{c} double" for c in cols)).repartition(3)
    got = {(r.a, r.b): r.r for r in profile.correlation_long(df, cols).collect()}
    few = {(r.a, r.b): r.r for r in profile.correlation_long(df, cols[:5], method="pairs").collect()}
    assert len(got) == 780
    for (a, b), r in got.items():
        i, j = int(a[1:]), int(b[1:])
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if j == 39:
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert all(got[k] == pytest.approx(v, abs=1e-9) for k, v in few.items())


def test_null_groups_in_both_quantile_paths(spark):
    rows = [("a", float(i)) for i in range(50)] + [(None, float(i * i)) for i in range(31)] + [("b", None), ("c", 7.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    few = {r.g: r.q for r in quantiles(df, "v", [0.1, 0.5, 0.9], by=["g"], exact=True).collect()}
    many = {r.g: r.q for r in quantiles(df, "v", [0.1, 0.5, 0.9], by=["g"], exact="bracket", accuracy=50).collect()}
    assert few.keys() == many.keys() == {"a", None, "c"}
    for g in few:
        assert many[g] == pytest.approx(few[g])
    for exact in (True, "bracket"):
        stats, _ = profile.box_stats(df, "v", "g", exact=exact)
        out = {r.g: r for r in stats.collect()}
        assert out["b"].n == 0 and out["b"].median is None and out[None].n == 31


def test_empty_side_of_the_ranged_ks(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True), (3.0, True)], "v double, ref boolean")
    for bound in (10, 0):
        row = drift.ks(df, ["v"], F.col("ref"), max_distinct=bound).first()
        assert row.ks is None and (row.n_ref, row.n_cur) == (3, 0)


def test_metrics_use_complete_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (8.0, 7.0), (1000.0, None), (None, 5.0)],
                               "y_true double, y_pred double")
    m = regression_metrics(df).first()
    assert (m.n, m.n_unscored, m.mae) == (3, 2, pytest.approx(2 / 3))
    y, p = np.array([1.0, 3, 8]), np.array([2.0, 3, 7])
    assert m.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert rmsle(df).first().n == 3


def test_csv_quotes_line_breaks_and_number_suffixes(spark, scratch):
    path = os.path.join(scratch, "t.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n"say ""hi"", ok",3F,1.5\n"two\nlines",2D,1e3\n')
    df = read_csv(spark, path, multi_line=True)
    assert dict(df.dtypes) == {"a": "string", "b": "string", "c": "double"}
    assert [tuple(r) for r in df.collect()] == [('say "hi", ok', "3F", 1.5), ("two\nlines", "2D", 1000.0)]


def test_histogram_edges(spark):
    none = spark.createDataFrame([(None,)], "v double")
    assert profile.histogram(none, "v").count() == 0
    some = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    assert [r.n for r in profile.histogram(some, "v", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 1]


def test_all_pairs_equal_single_pairs(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    every = {(r.x, r.y, r.bx, r.by): r.n for r in profile.all_pair_bins(li, cols).collect()}
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            one = {(a, b, r.bx, r.by): r.n for r in profile.pair_bins(li, a, b).where("n > 0").collect()}
            assert one == {k: v for k, v in every.items() if k[:2] == (a, b)}


def test_quarantine_of_repeated_values(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "z")], "k int, v string")
    rules = [checks.Rule("k.unique", "unique", "k"), checks.Rule("v.set", "not_null", "v")]
    got = sorted((r.k, r.v, r.failed_rules) for r in checks.quarantine(df, rules).collect())
    assert got == [(1, "x", ["k.unique"]), (1, "y", ["k.unique"]), (2, None, ["v.set"])]
    assert checks.rule_report(df, []).count() == 0 and checks.quarantine(df, []).count() == 0


def test_manifest_keeps_every_row_once(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "k int")
    man = spark.createDataFrame([(0, "train"), (1, "test"), (1, "test")], "k int, split string")
    assert sorted((r.k, r.split) for r in manifest_split(df, man, "k").where("k < 2").collect()) == [(0, "train"), (1, "test")]
    assert manifest_split(df, man, "k").where("split is null").count() == 2
    with pytest.raises(ValueError):
        manifest_split(df, man.unionByName(spark.createDataFrame([(0, "test")], "k int, split string")), "k")


def test_many_strata_are_joined(spark, monkeypatch):
    from sparktab.operators import split as S
    df = spark.createDataFrame([(i, i % 7 if i % 11 else None) for i in range(300)], "k int, s int")
    few = {r.k: r.split for r in S.stratified_split(df, ["k"], "s", 0.3, 1).collect()}
    monkeypatch.setattr(S, "MAX_STRATA", 2)
    many = {r.k: r.split for r in S.stratified_split(df, ["k"], "s", 0.3, 1).collect()}
    assert few == many and sum(v == "test" for v in few.values()) >= 90


def test_tree_with_booleans_and_nulls(spark):
    from sparktab.operators.models import fit_gbt, predict_tree
    df = spark.createDataFrame([(float(i), i % 2 == 0, 10.0 * i) for i in range(40)]
                               + [(None, True, 1.0), (1.0, None, 10.0), (2.0, False, None)],
                               "x double, flag boolean, y double")
    model = fit_gbt(df, ["x"], ["flag"], "y", maxIter=5, maxDepth=2, seed=1)
    out = predict_tree(model, df, ["x"], ["flag"])
    assert out.columns == ["x", "flag", "y", "y_pred"] and dict(out.dtypes)["flag"] == "boolean"
    assert out.where("y_pred is null").count() == 1 == out.where("x is null").count()


def test_refit_of_the_best_trial(spark):
    from sparktab.operators.search import random_search, refit_best, sample_params
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    num, target = ["l_quantity", "l_discount"], "l_extendedprice"
    fit, valid = li.where("l_orderkey % 3 > 0"), li.where("l_orderkey % 3 = 0")
    table, best = random_search(fit, valid, num, [], target, n_trials=2, executions=1, seed=4)
    rows = table.collect()
    assert [r.val_mse for r in rows] == sorted(r.val_mse for r in rows)
    assert best == json.loads(rows[0].params) and best in sample_params(2, 4)
    model = refit_best(li, num, [], target, best)
    y = [(r.l_extendedprice, r.y_pred) for r in model.transform(li).collect()]
    spread = np.var([a for a, _ in y])
    assert np.mean([(a - b) ** 2 for a, b in y]) < spread
    with pytest.raises(ValueError):
        sample_params(10_000, 1)

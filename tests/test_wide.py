from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators.features import fit_features
from sparktab.operators.models import fit_linear
from sparktab.operators.roles import Roles
from sparktab.operators.wide import Blocks, conjugate_gradients, fit_linear_wide, gram_blocks, times


def made(spark, n=500, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, float(rng.normal(3, 2)), float(rng.normal()), str(rng.choice(list("pqrst"))), str(rng.choice(list("uvw"))))
            for i in range(n)]
    rows = [(*r, 2 * r[1] - r[2] + "pqrst".index(r[3]) * 0.7 + float(rng.normal())) for r in rows]
    rows += [(n, None, 1.0, "p", "u", 1.0), (n + 1, 1.0, 1.0, None, None, 2.0), (n + 2, 1.0, 1.0, "p", "u", None)]
    return spark.createDataFrame(rows, "k int, a double, b double, c string, d string, y double").repartition(3)


def close(a, b, rel=1e-8):
    assert a.intercept == pytest.approx(b.intercept, rel=rel)
    assert [x[:3] for x in a.numeric] == [x[:3] for x in b.numeric]
    assert [x[3] for x in a.numeric] == pytest.approx([x[3] for x in b.numeric], rel=rel, abs=rel)
    for (c, lw), (e, mw) in zip(a.categorical, b.categorical):
        assert c == e and [x for x, _ in lw] == [x for x, _ in mw]
        assert [w for _, w in lw] == pytest.approx([w for _, w in mw], rel=rel, abs=rel)


@pytest.mark.parametrize("block", [2, 5, 64])
def test_equals_the_dense_solve(spark, block):
    df = made(spark)
    fm = fit_features(df, Roles(["a", "b"], ["c", "d"]), target="y")
    close(fit_linear_wide(df, fm, "y", block=block), fit_linear(df, fm, "y"))


def test_rank_deficient_design(spark):
    df = made(spark).withColumn("twice", F.col("a") * 2).withColumn("same", F.lit(1.0)).withColumn("e", F.col("c"))
    fm = fit_features(df, Roles(["a", "twice", "same"], ["c", "e"]), target="y")
    close(fit_linear_wide(df, fm, "y", block=4), fit_linear(df, fm, "y"), rel=1e-7)


def test_numeric_or_categorical_alone_and_no_rows(spark):
    df = made(spark)
    for roles in (Roles(["a"], []), Roles([], ["c"])):
        fm = fit_features(df, roles, target="y")
        close(fit_linear_wide(df, fm, "y", block=3), fit_linear(df, fm, "y"))
    fm = fit_features(df, Roles(["a"], ["c"]), target="y")
    with pytest.raises(ValueError):
        fit_linear_wide(df.where("k < 0"), fm, "y")


def test_blocks_add_repeated_places_and_hand_on():
    g = Blocks(3)
    g.add(np.array([0, 0, 4]), np.array([1, 1, 8]), np.array([1.0, 2.0, 5.0]))
    got = {(b.column(0)[0].as_py(), b.column(1)[0].as_py()): b.column(2)[0].as_py() for b in g.hand_on()}
    assert got.keys() == {(0, 0), (1, 2)} and got[0, 0][1] == 3.0 and got[1, 2][1 * 3 + 2] == 5.0 and not g.held


def test_matrix_times_vector(spark, monkeypatch):
    from sparktab.operators import wide

    monkeypatch.setattr(wide, "HOLD_BLOCKS", 1)  # pieces of one block come from one task more than once
    monkeypatch.setattr(wide, "ROWS", 50)
    df = made(spark)
    fm = fit_features(df, Roles(["a"], ["c", "d"]), target="y")
    blocks = gram_blocks(df, fm, "y", block=3).cache()
    rows = df.where("y is not null and a is not null").toPandas()
    cols = [np.ones(len(rows)), (rows.a - fm.means["a"]) / fm.scale("a"), rows.y - fm.target_mean]
    cols += [(rows[c].fillna("nan") == lv).astype(float) for c in "cd" for lv in fm.level_list(c)]
    x = np.array(cols).T
    v = np.random.default_rng(1).normal(size=x.shape[1])
    assert times(blocks, v, 3) == pytest.approx(x.T @ (x @ v))


def test_conjugate_gradients_give_the_minimum_norm():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 6)) @ rng.normal(size=(6, 12))
    a, b = x.T @ x, x.T @ rng.normal(size=30)
    got, n = conjugate_gradients(lambda p: a @ p, b)
    assert got == pytest.approx(np.linalg.pinv(x) @ np.linalg.lstsq(x.T, b, rcond=None)[0], rel=1e-5, abs=1e-7) and n < 60
    assert conjugate_gradients(lambda p: a @ p, np.zeros(12))[1] == 0


def test_five_thousand_columns(spark):
    """As many levels: no matrix of that width on the driver, and the prediction of plain means."""
    n, k = 20_000, 5_000
    df = spark.range(n).select(F.format_string("l%04d", F.col("id") % k).alias("c"),
                               ((F.col("id") % k) * 0.01 + F.when(F.col("id") < n / 2, 1.0).otherwise(-1.0)).alias("y"))
    fm = fit_features(df, Roles([], ["c"]), target="y", max_levels=k)
    model = fit_linear_wide(df, fm, "y")
    w = dict(model.categorical[0][1])
    assert len(w) == k and sum(w.values()) == pytest.approx(0, abs=1e-6)  # minimum norm
    for i in (0, 1234, 4999):
        assert model.intercept + w[f"l{i:04d}"] == pytest.approx(i * 0.01, abs=1e-6)

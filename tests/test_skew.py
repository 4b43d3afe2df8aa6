"""Hot-key behaviour: one level holding ~40% of the rows must give exact results."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sparktab.functions.hashing import hash_u32, threshold
from sparktab.operators import profile, stats
from sparktab.operators.split import stratified_split


@pytest.fixture(scope="module")
def skewed(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    hot = hash_u32(["l_orderkey", "l_linenumber"], 99) < threshold(0.4)
    return li.withColumn("g", F.when(hot, F.lit("HOT")).otherwise(F.col("l_returnflag"))) \
             .select("l_orderkey", "l_linenumber", "l_extendedprice", "g").repartition(16)


def test_stratified_split_with_hot_stratum(spark, skewed):
    s = stratified_split(skewed, ["l_orderkey", "l_linenumber"], "g", 0.2, 42)
    got = {(r.g, r.split): r["count"] for r in s.groupBy("g", "split").count().collect()}
    sizes = {r.g: r["count"] for r in skewed.groupBy("g").count().collect()}
    assert sizes["HOT"] > 0.35 * sum(sizes.values())
    for g, n in sizes.items():
        assert got[(g, "test")] + got.get((g, "train"), 0) == n
        assert math.ceil(n * 0.2) <= got[(g, "test")] <= math.ceil(n * 0.2) + 2  # duplicate keys tie


def test_box_stats_and_counts_with_hot_group(spark, skewed):
    pdf = skewed.toPandas()
    st, out = profile.box_stats(skewed, "l_extendedprice", "g")
    rows = {r.g: r for r in st.collect()}
    for g, grp in pdf.groupby("g"):
        q1, q3 = grp.l_extendedprice.quantile(0.25), grp.l_extendedprice.quantile(0.75)
        assert rows[g].q1 == pytest.approx(q1, rel=1e-12) and rows[g].q3 == pytest.approx(q3, rel=1e-12)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert rows[g].n_outliers == int(((grp.l_extendedprice < lo) | (grp.l_extendedprice > hi)).sum())
    lc = {r.level: r.n for r in stats.level_counts(skewed, ["g"]).collect()}
    assert lc == pdf.g.value_counts().to_dict()

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from sparktab.llm import exact_dedup, mixture


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_dedup_brute_force(odd, odd_rows):
    got = exact_dedup.exact_dedup(odd).collect()
    assert len(got) == len(odd_rows)
    groups = {}
    for i, t, *_ in odd_rows:
        groups.setdefault(hashlib.sha256(norm(t).encode()).hexdigest(), []).append(i)
    for r in got:
        ids = groups[r.text_sha256]
        least = min((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (least, len(ids))
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        assert not r.kept or r.id == r.keep_id


def test_few_tracked_items_give_the_same_result(odd):
    cols = ["id", "keep_id", "group_size", "text_sha256"]
    a = sorted(map(str, exact_dedup.exact_dedup(odd).select(cols).collect()))
    b = sorted(map(str, exact_dedup.exact_dedup(odd, max_items=8).select(cols).collect()))
    assert a == b


def test_dedup_documents_keeps_columns(odd):
    out = exact_dedup.dedup_documents(odd)
    assert out.columns == odd.columns
    assert out.count() == exact_dedup.exact_dedup(odd).where("kept").count()


def test_empty(nothing):
    assert exact_dedup.exact_dedup(nothing).count() == 0
    assert mixture.mix(nothing).count() == 0 and mixture.mix_documents(nothing).count() == 0


def test_water_filling(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixture.targets(sizes).collect()}
    # weights 5, 2, 1, 5: a stops at 30, c at 0, the rest is shared 2 : 5
    assert got["a"] == 30 and got["c"] == 0
    assert got["b"] == pytest.approx(1480 * 2 / 7) and got[None] == pytest.approx(1480 * 5 / 7)


def test_mix_near_targets(odd, odd_rows):
    got = mixture.mix(odd).toPandas()
    assert len(got) == len(odd_rows)
    assert (got.taken <= 3 * got["size"]).all()
    again = mixture.mix(odd.repartition(5)).toPandas()
    key = ["id", "size", "source_size", "taken"]
    assert got[key].sort_values(key).values.tolist().__repr__() == again[key].sort_values(key).values.tolist().__repr__()
    for (_, target), g in got.groupby(["source_size", "target"]):
        assert abs(g.taken.sum() - target) <= g["size"].max()


def test_mix_equals_sql(odd):
    docs = odd.select("doc_id", "text", "source").toPandas()  # noqa: F841
    docs.doc_id = docs.doc_id.astype("Int64")
    con = duckdb.connect()
    con.register("documents", docs)
    want = sorted(map(repr, con.execute(mixture.mix_sql()).fetchall()))
    got = mixture.mix(odd).select("id", "size", "source_size", "target", "taken")
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


def test_mix_documents_repeats_rows(odd):
    out = mixture.mix_documents(odd)
    assert out.columns == odd.columns
    assert out.count() == mixture.mix(odd).agg(F.sum("repetitions")).first()[0]

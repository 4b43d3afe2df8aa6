"""The pipeline's stages against their operators' brute-force twins, on the smallest test tables."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline as P
from sparktab.llm import simhash
from sparktab.llm.common import saved

from .test_simhash import slow_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(saved(stage(spark, out[-1], SF), "test-stage"))
    return out


def test_stages_keep_columns(steps):
    assert 4 <= len(P.STAGES) <= 5
    for d in steps[:-1]:
        assert d.columns == steps[0].columns


def test_quality_keeps_trusted_documents(spark, steps):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    left = {r.doc_id for r in steps[1].collect()}
    assert good <= left and len(left) < steps[0].count()


def test_exact_dedup(steps):
    first = {}
    for r in sorted(steps[1].collect(), key=lambda r: r.doc_id):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text), r.doc_id)
    assert {r.doc_id for r in steps[2].collect()} == set(first.values())


def test_near_dedup(steps):
    rows = sorted(steps[2].collect(), key=lambda r: r.doc_id)
    group = slow_components([simhash.fingerprint(r.text) for r in rows])
    assert sorted(r.doc_id for r in steps[3].collect()) == sorted(rows[g].doc_id for g in set(group))


def test_mix_and_pieces(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before, after = steps[3].collect(), steps[4].collect()
    assert abs(sum(size(r.text) for r in after) / sum(size(r.text) for r in before) - 1) < 0.1
    times = {}
    for r in after:
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    assert max(times.values()) <= 3
    last = steps[5].collect()
    assert len(last) == len(after) and all(r.lossless for r in last)


def test_run(spark, steps):
    got = P.run(spark, SF)
    assert sorted(map(str, got.collect())) == sorted(map(str, steps[5].collect()))

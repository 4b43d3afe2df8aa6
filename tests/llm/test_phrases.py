from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pytest

from sparktab.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, support, max_words, top, cover_percent=100):
    """rows: (text, lang) -> sorted result tuples, by plain counting."""
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    f.setdefault(lang, Counter())[tuple(ws[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        found = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= cover_percent * a
                   and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:c]] * counts[p[c:]]), c, counts[p[:c]], counts[p[c:]])
                                        for c in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(found[:top])]
    return sorted(out)


def some_rows(seed, docs, vocabulary=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É x", "A", "a", "...b"]
    rows = []
    for _ in range(docs):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "  "])
                       for _ in range(rng.randint(0, 120)))
        rows.append((text, rng.choice(["en", "en", "en", "de", "und", None])))
    return rows


@pytest.mark.parametrize("shard_words, bits, support", [(10, 20, 7), (300, 6, 9), (10**6, 20, 7), (300, 20, 40)])
def test_equals_brute_force(spark, shard_words, bits, support):
    rows = some_rows(1, 60) + [("x y z x y z " * 20, "en"), (None, "en"), ("", None), ("a a a a a a a a a a a a", "fr")]
    rows += rows[:10]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(4)
    got = phrases.collocations(df, support=support, top=40, shard_words=shard_words, bits=bits)
    assert sorted(map(tuple, got.collect())) == brute(rows, support, 5, 40)


def test_cover_percent(spark):
    rows = some_rows(3, 40, 4)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(3)
    got = phrases.collocations(df, support=5, top=1000, cover_percent=30, max_words=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 4, 1000, 30)


def test_sql_twin(spark):
    rows = some_rows(2, 50)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    want = sorted(con.execute(phrases.collocations_sql(support=6, top=30)).fetchall())
    assert sorted(map(tuple, phrases.collocations(df.repartition(3), support=6, top=30).collect())) == want


def test_odd_rows_and_empty(odd, odd_rows, nothing):
    got = phrases.collocations(odd, support=3)
    assert sorted(map(tuple, got.collect())) == brute([(r[1], r[2]) for r in odd_rows], 3, 5, 2000)
    assert phrases.collocations(nothing).count() == 0


def test_large_numbers_stay_exact(spark):
    """1000 a n passes 64 bits where a and n are large; the expression is the same."""
    from pyspark.sql import functions as F

    a, n, left = 3 * 10**12 + 1, 9 * 10**13 + 7, 4 * 10**12 + 3
    df = spark.createDataFrame([(a, n, left, left)], "a long, n long, l long, r long")
    assert df.select(F.expr(phrases.SCORE).alias("s")).first().s == 1000 * a * n // (left * left)
    assert df.select(F.typeof(F.expr(phrases.SCORE))).first()[0] == "bigint"


def test_exact_groups_beyond_64_bits():
    import numpy as np

    rng = np.random.default_rng(0)
    ids = rng.integers(1, 1 << 20, 400).astype(np.int32)
    ids = np.r_[ids, ids, ids[:100]]
    at = np.arange(len(ids) - 5)
    where, n = phrases.exact_groups(ids, at, 5)
    want = Counter(tuple(ids[i:i + 5].tolist()) for i in at)
    assert {tuple(ids[i:i + 5].tolist()): int(c) for i, c in zip(where, n)} == want


def test_phrases_spread_thinly_over_shards_are_found(spark):
    """Every shard holds just below, at or above its share of the support."""
    rng = random.Random(9)
    rows = []
    for i in range(40):
        filler = [f"f{rng.randint(0, 5)}" for _ in range(60)]
        rows.append((" ".join(filler[:30] + ["rare", "pair"] * (1 if i % 4 else 2) + filler[30:]) + " . , !", "en"))
    rows += [(". , ; !", "en"), ("...", "de")]  # shards without words
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA).repartition(20)
    for support in (30, 40, 49, 50, 51):
        got = phrases.collocations(df, support=support, shard_words=100)
        assert sorted(map(tuple, got.collect())) == brute(rows, support, 5, 2000)

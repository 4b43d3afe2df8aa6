from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparktab.llm import rules

from .conftest import SCHEMA, invented


def plain_features(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), again, len(covered))


def plain_model(texts, order):
    """-log2 of interpolated modified Kneser-Ney, by the textbook recursion; the texts train it."""
    count = {n: Counter() for n in range(1, order + 1)}
    for t in texts:
        s = [255] * (order - 1) + list(t)
        for i in range(len(t)):
            count[order][tuple(s[i:i + order])] += 1
    for n in range(order - 1, 0, -1):
        for g in count[n + 1]:
            count[n][g[1:]] += 1
    spare = {}
    for n, c in count.items():
        k = Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] else None
        spare[n] = [min(max(i - (i + 1) * y * k[i + 1] / k[i] if y is not None and k[i] else 0.5, 0.05), i - 0.05)
                    for i in (1, 2, 3)]
    after = {n: defaultdict(list) for n in count}
    for n, c in count.items():
        for g, x in c.items():
            after[n][g[:-1]].append(x)

    def p(g):
        n = len(g)
        if not n:
            return 1 / 256
        rest = after[n].get(g[:-1])
        if not rest:
            return p(g[1:])
        d = lambda x: spare[n][min(x, 3) - 1]
        x = count[n].get(g, 0)
        return ((x - d(x) if x else 0) + sum(map(d, rest)) * p(g[1:])) / sum(rest)

    return lambda g: -math.log2(p(g))


def corpus(seed, n=40):
    """Prose, and jumble under the ids from 1000 on."""
    rng = random.Random(seed)
    rows = [(i, invented(rng, rng.randint(40, 90)), rng.choice(["en", "de", None]), "s", 1) for i in range(n)]
    rows += [(1000 + i, " ".join(w + rng.choice(["***", "%%%"]) for w in invented(rng, 70).split()), "en", "s", 1) for i in range(4)]
    return rows


def test_features():
    texts = ["", "a", "a b c a b c", "a a a a", "x\n\nx\n x\n\t\n\t\nx", "é # € *|\x0b<b> é # € *|", "a b c d a b c", "\x1c a b"]
    raw = [t.encode() for t in texts]
    assert [tuple(r) for r in rules.features(texts, raw).tolist()] == [plain_features(t) for t in texts]
    rng = random.Random(0)
    many = [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) + rng.choice(["\n", ""]) * 3 for _ in range(300)]
    got = rules.features(many, [t.encode() for t in many]).tolist()
    assert [tuple(r) for r in got] == [plain_features(t) for t in many]


@pytest.mark.parametrize("order, block_bytes", [(3, 500), (4, 10**6)])
def test_equals_plain_model(spark, order, block_bytes):
    rows = corpus(1)
    rows += rows[:3]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = rules.scores(df, order=order, block_bytes=block_bytes).collect()
    assert len(got) == len(rows)
    want = defaultdict(list)
    for lang in ("en", "de", None):
        mine = [r for r in rows if r[2] == lang]
        feats = {id(r): np.array([plain_features(r[1])]) for r in mine}
        judged = [r for r in mine if not rules.failed(feats[id(r)])[0]]
        cost = plain_model([r[1].encode() for r in judged if rules.plain(feats[id(r)])[0]], order)
        for r in mine:
            bits, size = 0.0, 0
            if r in judged:
                s = [255] * (order - 1) + list(r[1].encode())
                size = len(s) - order + 1
                bits = sum(cost(tuple(s[i:i + order])) for i in range(size))
            want[r[0]].append((*plain_features(r[1]), size, bits))
    for r in got:
        one = want[r.id].pop()
        assert tuple(r[f] for f in rules.FEATURES) + (r.bytes,) == one[:-1]
        assert r.bits == pytest.approx(one[-1], rel=1e-5)


def test_bands_reject_jumble_and_keep_prose(spark):
    rows = corpus(2, 150)
    got = {r.id: r for r in rules.quality_rules(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(rows)
    for i, *_ in rows:
        r = got[i]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and i < 1000)
        if not r.base_failed:
            assert r.kept == (r.lower <= r.score <= r.upper)


def test_odd_rows_and_empty(odd, odd_rows, nothing):
    got = rules.quality_rules(odd).collect()
    want = Counter((r[0], *plain_features(r[1])) for r in odd_rows)
    assert Counter((r.id, *(r[f] for f in rules.FEATURES)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed) and (r.perplexity is None) == r.base_failed
    assert rules.quality_rules(nothing).count() == 0


def test_language_without_plain_documents_keeps_all(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(w + "***" for w in invented(rng, 60).split()), "xx", "s", 1) for i in range(5)]
    got = rules.quality_rules(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.kept and r.score == pytest.approx(8) for r in got)

from __future__ import annotations

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from sparktab.llm import simhash
from sparktab.llm.components import components


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_fingerprints(odd_rows):
    for _, t, *_ in odd_rows[:20]:
        assert simhash.fingerprint(t) == slow_fingerprint(t)
    assert simhash.fingerprint("Aé B c") == slow_fingerprint("aé b C")


def crowd(rng, n):
    """Fingerprints around a few centres, flips spread or packed into one block."""
    centres, out = [rng.getrandbits(64) for _ in range(6)], set()
    for _ in range(n):
        x = rng.choice(centres)
        lo, hi = rng.choice([(0, 64), (0, 21), (21, 42), (42, 64), (5, 12)])
        for _ in range(rng.randint(0, 7)):
            x ^= 1 << rng.randrange(lo, hi)
        out.add(x)
    return sorted(out)


def test_links_join_exactly_the_near_ones(spark, monkeypatch):
    rng = random.Random(3)
    for direct in (1500, 3):
        monkeypatch.setattr(simhash, "DIRECT", direct)
        fps = crowd(rng, 250)
        moves = [(j, mask) for j, mask in enumerate(simhash.blocks(3))]
        rows = []
        for x in fps:
            for j, mask in moves:
                keep = ~mask & (1 << 64) - 1
                rows.append((j, x & keep, x))
                rows += [(j, (x ^ 1 << b) & keep, x) for b in range(64) if not mask >> b & 1]
        rows.sort()
        j, v, x = (np.array(c, np.uint64) for c in zip(*rows))
        found = simhash.links_of_runs(j.astype(np.int8), v, x, 3)
        assert (np.bitwise_count(found[:, 0] ^ found[:, 1]) <= 3).all()
        at = {f: i for i, f in enumerate(fps)}
        root = list(range(len(fps)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in found.tolist():
            a, b = find(at[a]), find(at[b])
            root[max(a, b)] = min(a, b)
        assert [find(i) for i in range(len(fps))] == slow_components(fps)


def test_links_on_spark(spark):
    fps = crowd(random.Random(8), 120)
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    found = components(simhash.links(nodes))
    root = {r.node: r.root for r in found.collect()}
    signed = [r.fp for r in nodes.collect()]
    want = slow_components(fps)
    same = {}
    for s, w in zip(signed, want):
        same.setdefault(w, set()).add(root.get(s, s))
    assert all(len(v) == 1 for v in same.values()) and len({next(iter(v)) for v in same.values()}) == len(same)


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 200))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_documents(odd, odd_rows, nothing):
    got = simhash.simhash_components(odd).collect()
    assert len(got) == len(odd_rows)
    fps = [slow_fingerprint(t) for _, t, *_ in odd_rows]
    group = slow_components(fps)
    ids = {}
    for (i, *_), g in zip(odd_rows, group):
        if i is not None:
            ids[g] = min(i, ids.get(g, i))
    want = sorted(repr((i, f"{f:016x}", ids.get(g))) for (i, *_), f, g in zip(odd_rows, fps, group))
    assert sorted(repr((r.id, r.fingerprint, r.component_id)) for r in got) == want
    kept = simhash.near_dedup_documents(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(group))
    assert simhash.simhash_components(nothing).count() == 0
    assert simhash.near_dedup_documents(nothing.withColumn("x", F.lit(1))).count() == 0

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def shifted():
    return F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def brute(rows, scale=256, positives=5, k=3, low=50, high=95, every=50):
    """rows: usable (id, label, vector) with distinct ids."""
    d = [(i, (c + 1) % 10 if i % 7 == 0 else c, np.floor(np.array(v, float) * scale).astype(object)) for i, c, v in rows]
    out = []
    for a, label, x in d:
        if a % every:
            continue
        x = [int(c) for c in x]
        scored = [(-sum(p * int(q) for p, q in zip(x, v)), i, c) for i, c, v in d if i != a]
        scored.sort()
        for ps, p, _ in [s for s in scored if s[2] == label][:positives]:
            inside = [(n, i) for n, i, c in scored if c != label and -low * ps <= -100 * n <= -high * ps]
            out += [(a, p, r + 1, i, -ps, -n) for r, (n, i) in enumerate(inside[:k])]
    return sorted(out)


def made(seed, n, dim, spread, same=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * spread
    x[:same] = x[0]
    ids = rng.permutation(3 * n)[:n]
    return [(int(i), int(c), v.tolist()) for i, c, v in zip(ids, rng.integers(0, 10, n), x)]


@pytest.mark.parametrize("spread, same, chunk, group, bucket, every", [
    (1.0, 0, 10_000, 512, 10**6, 50), (0.05, 0, 100, 7, 10, 10), (0.3, 200, 90, 4, 8, 10)])
def test_equals_brute_force(spark, spread, same, chunk, group, bucket, every):
    rows = made(1, 600, 8, spread, same)
    df = spark.createDataFrame([(i, v, c) for i, c, v in rows], SCHEMA).repartition(4)
    got = negatives.mine(df, F.col("id") % every == 0, shifted(), chunk=chunk, group_anchors=group, bucket_anchors=bucket)
    assert sorted(map(tuple, got.collect())) == brute(rows, every=every)


def test_odd_rows(spark):
    rows = made(2, 120, 4, 0.4)
    odd = [(None, [1.0] * 4, 1), (100_000, None, 1), (100_050, [1.0, None, 2.0, 3.0], 1), (100_100, [float("nan")] * 4, 1),
           (100_150, [float("inf"), 0.0, 0.0, 0.0], 2), (100_200, [1.0] * 4, None), (100_250, [1.0, 2.0], 3), (100_300, [], 3)]
    zero = [(100_350, 2, [0.0] * 4)]
    again = [(i, v, c) for i, c, v in rows[:30]]
    d = spark.createDataFrame([(i, v, c) for i, c, v in rows + zero] + odd + again, SCHEMA)
    for name in ("id", "vec", "rank", "chunk", "bucket", "windows", "a.b"):
        d = d.withColumn(name, F.lit("clash"))
    got = negatives.mine(d.repartition(3), F.col("id") % 10 == 0, shifted(), chunk=40, group_anchors=5)
    assert sorted(map(tuple, got.collect())) == brute(rows + zero, every=10)


def test_empty_and_lonely(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(none, F.col("id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(50, [1.0, 2.0], 1), (51, [1.0, 2.0], 2)], SCHEMA)
    assert negatives.mine(one, F.col("id") % 50 == 0).count() == 0  # no positive


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 3, (rng.integers(1, 1 << 21, 6) + rng.random(6)).tolist()) for i in range(60)]
    df = spark.createDataFrame([(i, v, c) for i, c, v in rows], SCHEMA).repartition(2)
    got = negatives.mine(df, F.col("id") % 5 == 0, shifted(), chunk=20, group_anchors=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, every=5)


def test_bounds_leave_rows_unscored():
    """With close anchors, most rows are never scored, and the result is the same."""
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(2000, 16)) * 256).astype(np.int64)
    anchors = x[0] + rng.integers(-3, 4, size=(20, 16))
    ids, labels = np.arange(2000), rng.integers(0, 5, 2000)
    order, parent, edge = negatives.spanning_tree(anchors.astype(float))
    group = (list(range(10_000, 10_020)), [0] * 20, anchors[order], parent, edge, [])
    block = negatives.Block(ids, labels, x)
    scored = []
    exact = block.score
    block.score = lambda a, at=None: (scored.append(len(x) if at is None else len(at)), exact(a, at))[1]
    got = list(negatives.find_positives(block, group, 5))
    for i, a in enumerate(anchors[order]):
        s = x @ a
        own = np.flatnonzero(labels == 0)
        want = own[np.lexsort((own, -s[own]))][:5]
        assert [g[1] for g in got if g[0] == 10_000 + i] == want.tolist()
    assert sum(scored[1:]) < 0.2 * 19 * (labels == 0).sum()


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 3))
    order, parent, edge = negatives.spanning_tree(x)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[i] < i for i in range(1, 40))
    d = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    assert np.allclose([d[order[i], order[parent[i]]] for i in range(1, 40)], edge[1:])
    joined, total = list(range(40)), 0.0  # Kruskal
    for w, a, b in sorted((d[i, j], i, j) for i in range(40) for j in range(i)):
        if joined[a] != joined[b]:
            joined = [joined[a] if c == joined[b] else c for c in joined]
            total += w
    assert edge.sum() == pytest.approx(total)

"""Operator 13: hard negatives, with scores bounded along a spanning tree of the anchors.

A row's components become integers, floor(``scale`` * x); a score is the integer inner
product with an anchor.  An anchor's positives are its ``positives`` best other rows of the
same label; for each positive, the first ``negatives`` rows of another label are wanted
whose score lies between ``low`` and ``high`` percent of the positive's.

1. *Groups.*  Anchors that lie on the same side of some fixed random hyperplanes form
   groups of at most ``group_anchors``.  Within a group, a minimum spanning tree over their
   distances is built once (Prim) and kept with the group in one row.
2. *Blocks.*  The rows are dealt to chunks of about ``chunk`` rows by their id's hash, and
   every group visits every chunk: a stated query set against all rows, in blocks.
3. *Bounds.*  In a block the root of the tree is scored with all rows.  A child's score
   with a row differs from its parent's by at most (length of the tree's edge) x (norm of the
   row), so bounds are carried down the tree, widened by each edge and made exact wherever
   a row was scored.  Scored are only rows whose bounds overlap what is asked:
   for positives the rows that may reach the k-th best lower bound, for negatives those that may
   lie in one of the anchor's windows and may reach the k-th best lower bound of the rows that
   surely lie in it.
4. Each block hands on at most k rows an anchor (and positive); the k best of these are the result.

Bounds are widened by a small relative amount, so rounding never excludes a row; all scores in
the result are exact integers.

Defined results: a row takes no part if its id, label or vector is null, if a component is
null or not finite, if the vector is empty or has another than the most common number of
components (ties: the larger); of rows with equal id the one with the smallest (label, vector)
takes part; equal scores are ordered by id; anchors without positives give no rows; an empty
table gives an empty result; other columns are not read.  Scores must fit 64 bits: larger ones
raise an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import col, saved

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
CHUNK = 8192
GROUP_ANCHORS = 512
SIDE_GROUPS = 64            # groups that one task makes of the anchors of one side
BUCKET_ANCHORS = 65_536     # anchors whose groups visit the same copy of a chunk
EXACT = 1 << 53             # integers up to here are exact in double precision
GROUP = ("gid long, ids array<long>, labels array<long>, vecs array<long>, parent array<int>, edge array<double>, "
         "windows array<array<array<long>>>")
FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def usable(rows: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int, label: Column | None) -> DataFrame:
    """(id, label, vec) of the rows that take part; ``label`` may be an expression over id and label."""
    v = col(vec_col)
    good = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    d = rows.where(col(id_col).isNotNull() & col(label_col).isNotNull() & v.isNotNull()).where(good)
    d = d.select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"),
                 F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vec"))
    if label is not None:
        d = d.select("id", label.cast("long").alias("label"), "vec")
    d = d.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")
    d = saved(d, "negatives-rows")
    dim = d.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return d.where(F.size("vec") == (dim["dim"] if dim else 0))


def matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of visits, parent (place in that order, -1 for the root) and edge length of a minimum spanning tree."""
    n = len(x)
    left = np.ones(n, bool)
    near, from_ = np.full(n, np.inf), np.full(n, -1)
    order, parent, edge = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n)
    place = np.empty(n, np.int64)
    at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    for i in range(n):
        order[i], place[at], left[at] = at, i, False
        parent[i] = place[from_[at]] if i else -1
        edge[i] = near[at] if i else 0.0
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = left & (d < near)
        near[closer], from_[closer] = d[closer], at
        at = int(np.where(left, near, np.inf).argmin())
    return order, parent, edge


def pack(anchors: DataFrame, total: int, group_anchors: int) -> DataFrame:
    """Anchors (id, label, vec, windows) as one row per group, in the order of the group's spanning tree."""
    bits = min(32, max(0, (total - 1) // group_anchors).bit_length())
    salt = F.pmod(F.xxhash64("id"), F.lit(-(-total // (SIDE_GROUPS * group_anchors))))  # most may be on one side

    def sides(batches):
        for b in batches:
            x = matrix(b.column(2)).astype(float) if b.num_rows else np.zeros((0, 1))
            planes = np.random.default_rng(11).normal(size=(x.shape[1], max(bits, 1)))
            side = ((x @ planes > 0) @ (1 << np.arange(max(bits, 1)))) if bits else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(side.astype(np.int64)), *b.columns],
                                             ["side", "id", "label", "vec", "windows"])

    placed = anchors.select("id", "label", "vec", "windows").mapInArrow(
        sides, "side long, id long, label long, vec array<long>, windows array<array<long>>")

    def group(held):
        ids, labels, x, windows = (list(c) for c in zip(*held))
        x = np.array(x, np.int64)
        order, parent, edge = spanning_tree(x.astype(float))
        return [ids[0], [ids[i] for i in order], [labels[i] for i in order], x[order].ravel().tolist(), parent.tolist(),
                edge.tolist(), [windows[i] for i in order]]

    def run(batches):
        now, held = None, []
        for b in batches:
            for side, *row in zip(*(c.to_pylist() for c in b.columns)):
                if held and (side != now or len(held) == group_anchors):
                    yield as_batch([group(held)])
                    held = []
                now = side
                held.append(row)
        if held:
            yield as_batch([group(held)])

    arrow = to_arrow_schema(placed.sparkSession.createDataFrame([], GROUP).schema)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    placed = placed.withColumn("side", F.xxhash64("side", salt))
    return placed.repartition("side").sortWithinPartitions("side", "id").mapInArrow(run, GROUP)


class Block:
    """The rows of a chunk, scored with anchors exactly."""

    def __init__(self, ids, labels, x):
        self.ids, self.labels, self.x = ids, labels, x
        self.float = x.astype(float)
        self.norm = np.sqrt((self.float ** 2).sum(axis=1)) * (1 + 1e-12)
        self.largest = float(np.abs(self.float).max(initial=0))

    def score(self, a: np.ndarray, at=None) -> np.ndarray:
        most = self.largest * float(np.abs(a.astype(float)).sum())
        if most >= 9.2e18:
            raise OverflowError("a score does not fit 64 bits")
        if most < EXACT:
            return ((self.float if at is None else self.float[at]) @ a.astype(float)).astype(np.int64)
        return (self.x if at is None else self.x[at]) @ a

    def walk(self, group, asked):
        """For each anchor of a group, the places asked for and their scores.

        ``asked(anchor number, low, high)`` gives the places of the rows to score from their bounds.
        """
        ids, vecs, parent, edge = group
        bounds = {}
        uses = np.bincount(parent[1:], minlength=len(ids)) if len(ids) > 1 else np.zeros(len(ids), int)
        for i in range(len(ids)):
            if i == 0:
                s = self.score(vecs[0])
                low = high = s.astype(float)
                at = asked(i, low, high)
                yield i, at, s[at]
            else:
                width = self.norm * edge[i]
                low, high = bounds[parent[i]]
                slack = 1e-9 * (1 + np.abs(low) + np.abs(high) + width)
                low, high = low - width - slack, high + width + slack
                at = asked(i, low, high)
                s = self.score(vecs[i], at)
                low[at] = high[at] = s
                yield i, at, s
                uses[parent[i]] -= 1
                if not uses[parent[i]]:
                    del bounds[parent[i]]
            if uses[i]:
                bounds[i] = low, high


def best_first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher scores, then smaller ids."""
    if len(score) > 4 * k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= edge)
        return some[np.lexsort((ids[some], -score[some]))][:k]
    return np.lexsort((ids, -score))[:k]


def kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def find_positives(block: Block, group, k: int):
    ids, labels, vecs, parent, edge, _ = group

    def asked(i, low, high):
        own = (block.labels == labels[i]) & (block.ids != ids[i])
        return np.flatnonzero(own & (high >= kth(low[own], k)))

    for i, at, s in block.walk((ids, vecs, parent, edge), asked):
        for j in best_first(s, block.ids[at], k):
            yield ids[i], int(block.ids[at[j]]), int(s[j]), None, None


def limits(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and greatest score s with low * score <= 100 * s <= high * score."""
    return -(-low * score // 100), high * score // 100


def find_negatives(block: Block, group, k: int, low_percent: int, high_percent: int):
    ids, labels, vecs, parent, edge, windows = group
    ranges = [[(p, s, *limits(s, low_percent, high_percent)) for p, s in w] for w in windows]

    def asked(i, low, high):
        other = block.labels != labels[i]
        want = np.zeros(len(other), bool)
        for _, _, least, most in ranges[i]:
            if least <= most:
                sure = other & (low >= least) & (high <= most)
                want |= other & (low <= most) & (high >= max(least, kth(low[sure], k)))
        return np.flatnonzero(want)

    for i, at, s in block.walk((ids, vecs, parent, edge), asked):
        for p, ps, least, most in ranges[i]:
            inside = np.flatnonzero((s >= least) & (s <= most))
            for j in best_first(s[inside], block.ids[at[inside]], k):
                yield ids[i], p, ps, int(block.ids[at[inside[j]]]), int(s[inside[j]])


def meet(data: DataFrame, groups: DataFrame, n_chunks: int, n_buckets: int, find) -> DataFrame:
    """Every group with every chunk; ``find(block, group)`` yields rows of ``FOUND``."""
    lit = {n: F.lit(None).cast(t.strip()) for n, t in (f.strip().split(" ", 1) for f in GROUP.split(", "))}
    rows = data.select(
        F.pmod(F.xxhash64("id"), F.lit(n_chunks)).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.lit(n_buckets - 1))).alias("bucket"), F.lit(0).alias("kind"), "id", "label", "vec",
        *[c.alias(n) for n, c in lit.items()])
    visits = groups.select(
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
        F.pmod(F.xxhash64("gid"), F.lit(n_buckets)).cast("int").alias("bucket"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("long").alias("label"),
        F.lit(None).cast("array<long>").alias("vec"), *lit)
    cells = (rows.unionByName(visits).repartition("chunk", "bucket")
             .sortWithinPartitions("chunk", "bucket", "kind", "id", "gid"))

    def run(batches):
        cell, parts, block = None, [], None
        for b in batches:
            key = np.c_[b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()]
            if not len(key):
                continue
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if cell != (now := (key[lo, 0], key[lo, 1])):
                    cell, parts, block = now, [], None
                part = b.slice(lo, hi - lo)
                if key[lo, 2] == 0:
                    parts.append((part.column(3).to_numpy(), part.column(4).to_numpy(), matrix(part.column(5))))
                    continue
                if not parts:
                    continue
                if block is None:
                    block = Block(*(np.concatenate(p) for p in zip(*parts)))
                for row in range(part.num_rows):
                    g = [part.column(c)[row] for c in range(7, 13)]
                    ids = g[0].as_py()
                    vecs = g[2].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                    group = (ids, g[1].as_py(), vecs, np.array(g[3].as_py()), np.array(g[4].as_py()), g[5].as_py())
                    found = list(find(block, group))
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*found)],
                            ["anchor_id", "positive_id", "positive_score", "id", "score"])

    return cells.mapInArrow(run, FOUND)


def mine(rows: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id", label_col: str = "label",
         vec_col: str = "embedding", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, chunk: int = CHUNK, group_anchors: int = GROUP_ANCHORS,
         bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition over ``id``; ``label`` an optional expression over ``id`` and ``label``.
    """
    spark = rows.sparkSession
    data = usable(rows, id_col, label_col, vec_col, scale, label)
    total, n_anchors = data.agg(F.count(F.lit(1)), F.count(F.when(is_anchor, 1))).first()
    if not n_anchors:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                         "positive_score long, negative_score long")
    n_chunks, n_buckets = -(-total // chunk), -(-n_anchors // bucket_anchors)
    anchors = data.where(is_anchor)
    none = F.array().cast("array<array<long>>")
    groups = saved(pack(anchors.withColumn("windows", none), n_anchors, group_anchors), "negatives-groups")
    found = meet(data, groups, n_chunks, n_buckets, lambda block, group: find_positives(block, group, positives))
    w = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = found.withColumn("n", F.row_number().over(w)).where(F.col("n") <= positives)
    windows = found.groupBy("anchor_id").agg(
        F.collect_list(F.array("positive_id", "positive_score")).alias("windows"))  # at most ``positives`` entries
    asked = anchors.join(windows, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    groups = saved(pack(asked, n_anchors, group_anchors), "negatives-groups")
    found = meet(data, groups, n_chunks, n_buckets,
                 lambda block, group: find_negatives(block, group, negatives, low, high))
    w = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    out = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score"))


def mine_sql(anchor: str = "vec_id % 50 = 0", label: str = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END",
             scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
             high: int = HIGH) -> str:
    """The same over ``embeddings`` with distinct ids and vectors of one length."""
    return f"""
WITH d AS (
  SELECT vec_id, ({label})::BIGINT AS label,
         list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
a AS (SELECT * FROM d WHERE {anchor}),
s AS (SELECT a.vec_id AS anchor_id, d.vec_id AS id, a.label = d.label AS same,
             list_sum(list_transform(list_zip(a.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM a JOIN d ON a.vec_id <> d.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {positives})
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score)
WHERE rank <= {negatives}"""

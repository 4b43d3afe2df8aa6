"""Operator 7: nearest neighbours by a hierarchical k-means tree, searched best bin first.

Fit: k-means splits a bounded sample (``SAMPLE`` vectors, smallest hashes first) into
``branch`` parts, and each part again, down to leaves.  For the inner product,
vectors get one more component that brings all of them to the largest length, so
that the nearest centre is also the one with the largest inner product; queries
get a zero there.

Index: every vector descends to its leaf; leaves are cut into chunks of at most
about ``chunk`` rows.

Search: a priority queue holds the tree's nodes by their distance to the query;
the nearest is opened, and leaves are visited in the order in which they come
out.  How many leaves to visit is calibrated: for ``calibration`` vectors, the
exact neighbours over all rows are computed, and visits are widened until the
mean recall reaches ``recall`` (at most all leaves, which is exact).  A query whose
leaves hold no more than k rows goes on to further leaves until they do.  Queries
meet the rows of a chunk in one task; leaves that many queries visit are
spread by a salt taken from the calibration.  A query's k-th best score among the
sample's vectors in the leaves it visits is a floor under its k-th best there, so a chunk
hands on only what reaches it (nothing that belongs to the k best found lies below).

Defined results: a row takes no part if its id or vector is null, if a component
is null or not finite, if the vector is zero or has another than the most
common dimension (ties: the larger); of rows with equal id the smallest vector takes part; equal scores
are ordered by id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import col, saved

K = 20
SAMPLE = 20_000
BRANCH = 8
LEAF_ROWS = 1024
LEAF_SAMPLE = 8
CALIBRATION = 256
RECALL = 0.97
CHUNK = 8192
QUERIES_PER_CELL = 100_000
BLOCK = 512
FLOOR_BLOCK = 128
PAIRS = 1 << 16     # scores taken one by one at once


class Tree:
    """Centres of all nodes; node 0 is the root; ``leaf`` numbers the leaves, -1 elsewhere."""

    def __init__(self, x: np.ndarray, leaf_size: int, branch: int = BRANCH, seed: int = 7):
        rng = np.random.default_rng(seed)
        centres, self.children = [x.mean(axis=0)], [[]]
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) <= leaf_size:
                continue
            c, part = kmeans(x[rows], branch, rng)
            if len(c) < 2:
                continue
            for j in range(len(c)):
                self.children[node].append(len(centres))
                todo.append((len(centres), rows[part == j]))
                centres.append(c[j])
                self.children.append([])
        self.centres = np.array(centres)
        self.leaf = np.full(len(centres), -1)
        ends = [i for i, c in enumerate(self.children) if not c]
        self.leaf[ends] = np.arange(len(ends))
        self.leaves = len(ends)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each row descends to."""
        out, todo = np.empty(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf[node]
                continue
            near = distances(x[rows], self.centres[kids]).argmin(axis=1)
            todo += [(kid, rows[near == j]) for j, kid in enumerate(kids) if (near == j).any()]
        return out

    def visits(self, q: np.ndarray, most: int, size: np.ndarray | None = None, rows: int = 0):
        """For each query its first ``most`` leaves, best bin first, and more until they hold ``rows`` (``size``: of each leaf)."""
        for at in range(0, len(q), BLOCK):
            for d in distances(q[at:at + BLOCK], self.centres).tolist():
                heap, out, held = [(0.0, 0)], [], 0
                while heap and (len(out) < most or held < rows):
                    _, node = heapq.heappop(heap)
                    if self.children[node]:
                        for kid in self.children[node]:
                            heapq.heappush(heap, (d[kid], kid))
                    else:
                        out.append(int(self.leaf[node]))
                        held += int(size[out[-1]]) if size is not None else 0
                yield out


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :]


def kmeans(x: np.ndarray, k: int, rng, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Lloyd's algorithm from distinct random rows; empty parts are dropped."""
    distinct = np.unique(x, axis=0)
    c = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    part = distances(x, c).argmin(axis=1)
    for _ in range(rounds):
        n = np.bincount(part, minlength=len(c))
        c = np.array([x[part == j].mean(axis=0) for j in np.flatnonzero(n)])
        new = distances(x, c).argmin(axis=1)
        if (new == part).all():
            break
        part = new
    used, part = np.unique(part, return_inverse=True)
    return c[used], part


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) of the rows that take part; ids are distinct."""
    v = col(vec_col)
    good = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    d = rows.where(col(id_col).isNotNull() & good & F.exists(v, lambda x: x != 0))
    d = d.select(col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("vec"))
    d = saved(d.groupBy("id").agg(F.min("vec").alias("vec")), "vectors")
    dim = d.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return d.where(F.size("vec") == (dim["dim"] if dim else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lift(x: np.ndarray, longest2: float) -> np.ndarray:
    """Rows with one more component that makes all of them equally long."""
    return np.c_[x, np.sqrt(np.maximum(longest2 - (x * x).sum(axis=1), 0))]


def floors(q_ids, q, ids, x, leaf, visited, k) -> np.ndarray:
    """Of each query its k-th best score among some rows of the leaves it visits: its k-th best of all there is no lower.

    ``leaf``: of each of these rows; ``visited``: queries x leaves.
    """
    out = []
    order = np.argsort(ids, kind="stable")
    ids, x, leaf = ids[order], x[order], leaf[order]
    for at in range(0, len(q), FLOOR_BLOCK):
        s = q[at:at + FLOOR_BLOCK] @ x.T
        own = q_ids[at:at + FLOOR_BLOCK]
        pos = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        rows = np.flatnonzero(ids[pos] == own)
        s[rows, pos[rows]] = -np.inf
        s[~visited[at:at + FLOOR_BLOCK][:, leaf]] = -np.inf
        out.append(np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k
                   else np.full(len(s), -np.inf))
    f = np.concatenate(out) if out else np.zeros(0)
    return np.where(np.isfinite(f), f - 1e-9 * (1 + np.abs(f)), -np.inf)  # sums may differ in their last digits


def scores_of(q, x) -> np.ndarray:
    """Inner products of rows with rows, each summed in one order wherever the row lies, so that equal vectors score equally."""
    return (np.ascontiguousarray(q) * np.ascontiguousarray(x)).sum(axis=1)


def best(q_ids, q, ids, x, k, floor=None):
    """Of each query its k best candidates, if they reach its floor: (query id, candidate id, score).

    A matrix product, whose last digits depend on a row's place, finds the candidates; their
    scores are then taken one by one.
    """
    out = []
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    for at in range(0, len(q), BLOCK):
        s = q[at:at + BLOCK] @ x.T
        own = q_ids[at:at + BLOCK]
        pos = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
        rows = np.flatnonzero(ids[pos] == own)
        s[rows, pos[rows]] = -np.inf
        if s.shape[1] > k:  # all that reach the k-th score, so that ties go by id
            edge = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            edge = np.where(np.isfinite(edge), edge - 1e-9 * (1 + np.abs(edge)), edge)
            r, c = np.nonzero((s >= edge[:, None]) & (s > -np.inf))
        else:
            r, c = np.nonzero(s > -np.inf)
        if floor is not None:
            up = s[r, c] >= floor[at:at + BLOCK][r]
            r, c = r[up], c[up]
        v = np.empty(len(r))
        for i in range(0, len(r), PAIRS):
            some = slice(i, i + PAIRS)
            v[some] = scores_of(q[at:at + BLOCK][r[some]], x[c[some]])
        by = np.lexsort((ids[c], -v, r))
        r, c, v = r[by], c[by], v[by]
        first = np.searchsorted(r, np.arange(len(s)))
        keep = np.arange(len(r)) - first[r] < k
        out.append((own[r[keep]], ids[c[keep]], v[keep]))
    return [np.concatenate(p) for p in zip(*out)]


def _top(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


SCHEMA = "query_id long, vec_id long, score double"


def exact(data: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Exact neighbours of a stated, bounded set of queries over all rows of ``data``."""
    given = data.sparkSession.sparkContext.broadcast((q_ids, q))

    def run(batches):
        ids, q = given.value
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in best(ids, q, b.column(0).to_numpy(), matrix(b.column(1)), k)],
                    ["query_id", "vec_id", "score"])

    return _top(data.mapInArrow(run, SCHEMA), k)


def search(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K,
           sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, recall: float = RECALL, chunk: int = CHUNK,
           calibration: int = CALIBRATION, report: dict | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: of every usable row with ``is_query`` (over column ``id``) its k nearest."""
    spark = rows.sparkSession
    sc = spark.sparkContext
    data = usable(rows, id_col, vec_col)
    norm2 = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
    total, longest2 = data.agg(F.count(F.lit(1)), F.max(norm2)).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = data.orderBy(F.xxhash64("id"), "id").limit(min(sample, total)).toArrow()
    x = lift(matrix(drawn.column(1).combine_chunks()), longest2)
    tree = Tree(x, max(LEAF_SAMPLE, leaf_rows * len(x) // total))

    # calibration: exact neighbours, and where their leaves come in the order of visits
    take = drawn.slice(0, calibration)
    q_ids, q = take.column(0).to_numpy(), matrix(take.column(1).combine_chunks())
    truth = exact(data, q_ids, q, k).join(data.select(F.col("id").alias("vec_id"), "vec"), "vec_id").toArrow()
    flat = np.c_[q, np.zeros(len(q))]
    place = np.full((len(q), tree.leaves), tree.leaves)
    for i, order in enumerate(tree.visits(flat, tree.leaves)):
        place[i, order] = np.arange(len(order))
    row = {int(v): i for i, v in enumerate(q_ids)}
    visits = 1
    if truth.num_rows:
        who = np.array([row[v] for v in truth.column("query_id").to_pylist()])
        leaf = tree.assign(lift(matrix(truth.column("vec").combine_chunks()), longest2))
        need = place[who, leaf]
        while visits < tree.leaves and (need < visits).mean() < recall:
            visits += 1
    if report is not None:
        report |= {"leaves": tree.leaves, "visits": visits, "calibration": len(q)}

    given = sc.broadcast(tree)
    some = sc.broadcast((drawn.column(0).to_numpy(), x[:, :-1], tree.assign(x)))  # at most ``sample`` vectors

    def index(batches):
        for b in batches:
            x = lift(matrix(b.column(1)), longest2) if b.num_rows else np.zeros((0, 1))
            leaf = given.value.assign(x) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf)], ["id", "vec", "leaf"])

    placed = saved(data.mapInArrow(index, "id long, vec array<double>, leaf long"), "vector-index")
    size = dict(placed.groupBy("leaf").count().toArrow().to_pandas().itertuples(index=False))  # one row per leaf
    n_queries = placed.where(is_query).count()
    rows_of = np.array([size.get(i, 0) for i in range(tree.leaves)])
    share = np.zeros(tree.leaves)  # of the queries, by leaf
    for order in tree.visits(flat, visits, rows_of, k + 1):
        share[order] += 1 / len(flat)
    chunks = [max(1, -(-size.get(i, 0) // chunk)) for i in range(tree.leaves)]
    salts = [max(1, -(-int(share[i] * n_queries) // QUERIES_PER_CELL)) for i in range(tree.leaves)]
    per_leaf = sc.broadcast((np.array(chunks), np.array(salts), rows_of))

    def at(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("leaf") + 1).cast("int"))

    cells = placed.withColumn("chunk", F.pmod(F.xxhash64("id"), at(chunks))).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), at(salts) - 1)))
    cells = cells.select("leaf", F.col("chunk").cast("int").alias("chunk"), F.col("salt").cast("int").alias("salt"),
                         F.lit(0).alias("kind"), "id", "vec", F.lit(0.0).alias("floor"))

    def ask(batches):
        chunks, salts, rows_of = per_leaf.value
        for b in batches:
            ids = b.column(0).to_numpy()
            if not b.num_rows:
                continue
            q = np.c_[matrix(b.column(1)), np.zeros(b.num_rows)]
            rows, leaf = [], []
            for i, order in enumerate(given.value.visits(q, visits, rows_of, k + 1)):
                rows += [i] * len(order)
                leaf += order
            rows, leaf = np.array(rows, np.int64), np.array(leaf, np.int64)
            seen = np.zeros((len(ids), given.value.leaves), bool)
            seen[rows, leaf] = True
            floor = floors(ids, q[:, :-1], *some.value, seen, k)
            times = chunks[leaf] if len(leaf) else leaf
            c = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            rows, leaf = np.repeat(rows, times), np.repeat(leaf, times)
            salt = np.abs(ids[rows] // 64) % salts[leaf] if len(leaf) else leaf
            for i in range(0, len(rows), 10_000):
                part = slice(i, i + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[part]), pa.array(c[part], pa.int32()), pa.array(salt[part], pa.int32()),
                     pa.array(np.ones(len(rows[part]), np.int32)), pa.array(ids[rows[part]]),
                     b.column(1).take(pa.array(rows[part])), pa.array(floor[rows[part]])],
                    ["leaf", "chunk", "salt", "kind", "id", "vec", "floor"])

    asked = placed.where(is_query).select("id", "vec").mapInArrow(
        ask, "leaf long, chunk int, salt int, kind int, id long, vec array<double>, floor double")
    both = (cells.unionByName(asked).repartition("leaf", "chunk", "salt")
            .sortWithinPartitions("leaf", "chunk", "salt", "kind"))

    def meet(batches):
        cell, ids, parts = None, [], []  # the rows of the chunk at hand
        for b in batches:
            key = np.c_[b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(), b.column(3).to_numpy()]
            if not len(key):
                continue
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1), True])
            all_ids, all_vec, floor = b.column(4).to_numpy(), matrix(b.column(5)), b.column(6).to_numpy()
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if cell != (now := tuple(key[lo, :3].tolist())):
                    cell, ids, parts = now, [], []
                if key[lo, 3] == 0:
                    ids.append(all_ids[lo:hi])
                    parts.append(all_vec[lo:hi])
                elif ids:
                    if len(ids) > 1:
                        ids, parts = [np.concatenate(ids)], [np.concatenate(parts)]
                    found = best(all_ids[lo:hi], all_vec[lo:hi], ids[0], parts[0], k, floor[lo:hi])
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in found], ["query_id", "vec_id", "score"])

    return _top(both.mapInArrow(meet, SCHEMA), k).select("query_id", "rank", "vec_id", "score")

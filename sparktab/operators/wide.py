"""M1 for wide designs: the Gram matrix as keyed blocks on the cluster, solved by conjugate gradients.

1. *Blocks.*  One pass over the complete training rows.  A row is sparse: a constant, its
   numerics and the target, and one slot per categorical.  Each task adds its rows up into
   ``block x block`` pieces of the upper triangle, holding only pieces that occur, and hands them on
   as (bi, bj, piece) when they pass ``HOLD_BLOCKS``; Spark sorts them by key and adds them one at a time.
   The blocks are written to the shared folder.
2. *Solve.*  Conjugate gradients on the centred normal equations.  An iteration is one job
   over the blocks: the current direction goes to the tasks, and a vector comes back.  From a zero
   start the iterates stay in the range of the matrix, so the limit is the minimum-norm
   solution, as in ``fit_linear``, whatever the rank.

The driver holds vectors of the design's width and no matrix; a task holds at most
``HOLD_BLOCKS`` blocks.  Rows are read once, however many iterations are needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path
from .features import FeatureModel
from .models import LinearModel, _complete_rows, fit_linear
from .stats import level_key

BLOCK = 256
HOLD_BLOCKS = 256      # 128 MB of blocks at the default size
TOLERANCE = 1e-13      # of the residual's norm against the right side's
MAX_ITERATIONS = 2_000
ROWS = 4096            # worked on at once
WIDE = 1_000           # design columns from which the matrix stays on the cluster


def _slots(fm: FeatureModel) -> tuple[list[dict[str, int]], int]:
    """Slot of every level, by categorical (numerics come first: 1, z..., y), and the number of slots."""
    at, out = len(fm.numeric) + 2, []
    for c in fm.categorical:
        levels = fm.level_list(c)
        out.append({lv: at + i for i, lv in enumerate(levels)})
        at += len(levels)
    return out, at


class Blocks:
    """Upper-triangle pieces of a Gram matrix."""

    def __init__(self, block: int):
        self.block, self.held = block, {}

    def add(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> None:
        """Add values at (row, column) with row <= column; places may repeat."""
        b = self.block
        key = rows // b << 32 | cols // b
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0, True]) if len(key) else []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = order[lo:hi]
            i, j = int(rows[part[0]] // b), int(cols[part[0]] // b)
            piece = self.held.setdefault((i, j), np.zeros(b * b))
            piece += np.bincount(rows[part] % b * b + cols[part] % b, values[part], b * b)

    def hand_on(self):
        for (i, j), piece in self.held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([piece.tolist()])],
                                             ["bi", "bj", "piece"])
        self.held = {}


def gram_blocks(train: DataFrame, fm: FeatureModel, target: str, block: int = BLOCK) -> DataFrame:
    """(bi, bj, piece): the Gram matrix of [1, z..., y, levels...] over complete rows, in blocks of the upper triangle."""
    if fm.target_mean is None:
        raise ValueError("FeatureModel was fitted without the target; pass target= to fit_features")
    used = _complete_rows(train, fm, target)
    y = F.col(target).cast("double") - F.lit(fm.target_mean)
    rows = used.select(F.array(F.lit(1.0), *[fm.standardized(c) for c in fm.numeric], y).alias("dense"),
                       F.array(*[level_key(used, c) for c in fm.categorical]).cast("array<string>").alias("levels"))
    slots, _ = _slots(fm)
    given = train.sparkSession.sparkContext.broadcast(slots)  # as many levels as the fitted model has
    width, schema = len(fm.numeric) + 2, "bi int, bj int, piece array<double>"

    def run(batches):
        g = Blocks(block)
        upper = np.triu_indices(width)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                n = part.num_rows
                dense = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
                g.add(*upper, (dense.T @ dense)[upper])
                names = part.column(1).flatten().to_pylist()
                count = len(slots)
                found = [np.fromiter((known.get(v, -1) for v in names[c::count]), np.int64, n)
                         for c, known in enumerate(given.value)]
                for c, mine in enumerate(found):
                    seen = np.flatnonzero(mine >= 0)
                    if not len(seen):
                        continue
                    # sums of the dense columns by level
                    levels, which = np.unique(mine[seen], return_inverse=True)
                    sums = np.zeros((len(levels), width))
                    np.add.at(sums, which, dense[seen])
                    g.add(np.tile(np.arange(width), len(levels)), np.repeat(levels, width), sums.ravel())
                    n_own = np.bincount(which).astype(float)
                    g.add(levels, levels, n_own)
                    for other in found[c + 1:]:
                        both = seen[other[seen] >= 0]
                        g.add(mine[both], other[both], np.ones(len(both)))
                if len(g.held) > HOLD_BLOCKS:
                    yield from g.hand_on()
        yield from g.hand_on()

    parts = rows.mapInArrow(run, schema).repartition("bi", "bj").sortWithinPartitions("bi", "bj")

    def add_up(batches):
        key, total = None, None
        for b in batches:
            for bi, bj, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                piece = piece.values.to_numpy(zero_copy_only=False)
                if key == (bi, bj):
                    total = total + piece
                    continue
                if key is not None:
                    yield _piece(key, total)
                key, total = (bi, bj), piece
        if key is not None:
            yield _piece(key, total)

    return parts.mapInArrow(add_up, schema)


def _piece(key, total):
    return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                       pa.array([total.tolist()])], ["bi", "bj", "piece"])


def times(blocks: DataFrame, v: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The Gram matrix times a vector, in one job over the blocks."""
    given = blocks.sparkSession.sparkContext.broadcast(np.r_[v, np.zeros(-len(v) % block)])

    def run(batches):
        out = np.zeros(len(given.value))
        for b in batches:
            for bi, bj, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                m = piece.values.to_numpy(zero_copy_only=False).reshape(block, block)
                rows, cols = slice(bi * block, (bi + 1) * block), slice(bj * block, (bj + 1) * block)
                if bi == bj:  # entries on and above the diagonal are held
                    m = np.triu(m) + np.triu(m, 1).T
                    out[rows] += m @ given.value[cols]
                else:
                    out[rows] += m @ given.value[cols]
                    out[cols] += m.T @ given.value[rows]
        at = np.flatnonzero(out)
        for i in range(0, len(at), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(at[i:i + 10_000]), pa.array(out[at[i:i + 10_000]])], ["i", "x"])

    got = blocks.mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
    out = np.zeros(len(v))
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    given.unpersist()
    return out


def conjugate_gradients(apply, b: np.ndarray, tolerance: float = TOLERANCE, most: int = MAX_ITERATIONS) -> tuple[np.ndarray, int]:
    """Minimum-norm solution of the consistent system with the positive semi-definite ``apply``, and the iterations."""
    x, rest = np.zeros(len(b)), b.copy()
    p, size = rest.copy(), float(rest @ rest)
    least = (tolerance ** 2) * size
    for i in range(most):
        if size <= least or size == 0.0:
            return x, i
        q = apply(p)
        curve = float(p @ q)
        if curve <= 0.0:  # only rounding is left
            return x, i
        step = size / curve
        x += step * p
        rest -= step * q
        new = float(rest @ rest)
        p = rest + (new / size) * p
        size = new
    return x, most


def fit_linear_wide(train: DataFrame, fm: FeatureModel, target: str, block: int = BLOCK,
                    tolerance: float = TOLERANCE) -> LinearModel:
    """M1 for wide designs (see the module); the same model as ``fit_linear`` but for rounding.  ``rank`` is not known: 0."""
    spark = train.sparkSession
    slots, width = _slots(fm)
    numeric = len(fm.numeric)
    path = scratch_path(spark, "gram-blocks")
    gram_blocks(train, fm, target, block).write.parquet(path)
    blocks = spark.read.schema("bi int, bj int, piece array<double>").parquet(path)
    try:
        unit = np.zeros(width)
        unit[0] = 1.0
        sums = times(blocks, unit, block)
        n = sums[0]
        if n == 0:
            raise ValueError("no complete training rows to fit")
        unit = np.zeros(width)
        unit[numeric + 1] = 1.0
        with_y = times(blocks, unit, block)
        design = np.r_[np.arange(1, numeric + 1), np.arange(numeric + 2, width)]

        def apply(v):
            whole = np.zeros(width)
            whole[design] = v
            return times(blocks, whole, block)[design] - sums[design] * (sums[design] @ v / n)

        w, _ = conjugate_gradients(apply, with_y[design] - sums[design] * sums[numeric + 1] / n, tolerance)
    finally:
        delete_path(spark, path)
    intercept = fm.target_mean + (sums[numeric + 1] - sums[design] @ w) / n
    weight = dict(zip(design.tolist(), w.tolist()))
    return LinearModel(float(intercept), [(c, fm.means[c], fm.scale(c), weight[i + 1]) for i, c in enumerate(fm.numeric)],
                       [(c, [(lv, weight[known[lv]]) for lv in fm.level_list(c)]) for c, known in zip(fm.categorical, slots)])


def fit_least_squares(train: DataFrame, fm: FeatureModel, target: str) -> LinearModel:
    """M1 at any width: the dense solve up to ``WIDE`` design columns, blocks beyond; the same model but for rounding."""
    columns = len(fm.numeric) + sum(len(fm.levels[c]) for c in fm.categorical)
    return (fit_linear if columns <= WIDE else fit_linear_wide)(train, fm, target)

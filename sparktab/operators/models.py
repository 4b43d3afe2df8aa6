"""Estimators (M1, M2).

M1 least squares
----------------
The design is the full encoding: standardised numerics plus one 0/1 column per
training level.  With an intercept that design is rank deficient (each one-hot
block sums to one), and the reference's solver returns the minimum-norm
solution.  We reproduce it exactly:

1. One distributed pass accumulates the *centred* Gram matrix ``U'U`` and
   ``U'y`` (``U`` = design minus its training means, ``y`` minus its mean):
   a JVM aggregate of pairwise sums for narrow designs, per-task numpy BLAS
   partials summed by Spark for wide ones.  Only a ``(d+1)^2`` array reaches
   the driver.
2. The driver solves the ``d x d`` system with an eigen pseudo-inverse: the
   minimum-norm solution, whatever the rank.
3. The fit is kept as a coefficient table and scored with one column
   expression: ``b + sum w (x-mean)/scale + sum coalesce(map[level], 0)``.
   An unseen level contributes zero, as in the reference's one-hot encoder.

M2 uses Spark ML (``GBTRegressor`` over an indexer/one-hot/assembler pipeline); its search is in ``search``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import local_table
from .features import FeatureModel
from .stats import NULL_LEVEL, level_key

PRED = "y_pred"


@dataclass
class LinearModel:
    intercept: float
    numeric: list[tuple[str, float, float, float]]          # (feature, mean, scale, weight)
    categorical: list[tuple[str, list[tuple[str, float]]]]  # (feature, [(level, weight)])
    rank: int = 0

    def predict_col(self, df: DataFrame | None = None) -> Column:
        expr = F.lit(self.intercept)
        for c, mean, scale, w in self.numeric:
            expr = expr + F.lit(w) * ((F.col(c).cast("double") - F.lit(mean)) / F.lit(scale))
        for c, lw in self.categorical:
            if not lw:
                continue
            key = level_key(df, c) if df is not None else F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL))
            m = F.create_map(*[x for lv, w in lw for x in (F.lit(lv), F.lit(w))])
            expr = expr + F.coalesce(F.try_element_at(m, key), F.lit(0.0))
        return expr

    def predict(self, df: DataFrame, out: str = PRED) -> DataFrame:
        return df.withColumn(out, self.predict_col(df))

    def coefficients(self, spark) -> DataFrame:
        rows = [("__intercept__", None, self.intercept)]
        rows += [(c, None, w) for c, _, _, w in self.numeric]
        rows += [(c, lv, w) for c, lw in self.categorical for lv, w in lw]
        return local_table(spark, rows, "feature string, level string, w double")

    def to_json(self) -> str:
        return json.dumps({"intercept": self.intercept, "numeric": self.numeric,
                           "categorical": self.categorical, "rank": self.rank})

    @classmethod
    def from_json(cls, text: str) -> LinearModel:
        d = json.loads(text)
        return cls(d["intercept"], [tuple(x) for x in d["numeric"]],
                   [(c, [tuple(p) for p in lw]) for c, lw in d["categorical"]], d.get("rank", 0))


def centred_design(fm: FeatureModel, df: DataFrame) -> list[Column]:
    """Design columns minus their training means (z already has mean 0)."""
    cols = [fm.standardized(c) for c in fm.numeric]
    n = float(fm.n_rows)
    for c in fm.categorical:
        key = level_key(df, c)
        for lv in fm.level_list(c):
            p = fm.levels[c][lv] / n
            cols.append(F.when(key == F.lit(lv), F.lit(1.0 - p)).otherwise(F.lit(-p)))
    return cols


JVM_GRAM_MAX_TERMS = 2_000  # up to ~60 columns: one codegen'd aggregate of pairwise sums


def gram(df: DataFrame, cols: Sequence[Column]) -> np.ndarray:
    """Sum of outer products of the given double columns, computed on the cluster.

    Narrow designs use one JVM aggregate of the ``k(k+1)/2`` pairwise sums
    (partial aggregation per task, whole-stage codegen, no Python).  Wider
    designs fold each task's Arrow batches into one ``k x k`` array with numpy
    BLAS, and the partials are summed by a Spark aggregate keyed on the array
    slot, so the final reduction is spread over tasks too.
    """
    k = len(cols)
    names = [f"u{i}" for i in range(k)]
    x = df.select(*[c.cast("double").alias(n) for c, n in zip(cols, names)])
    out = np.zeros((k, k))
    if k * (k + 1) // 2 <= JVM_GRAM_MAX_TERMS:
        pairs = [(i, j) for i in range(k) for j in range(i, k)]
        for v, (i, j) in zip(x.agg(_pair_sums(pairs)).first()[0], pairs):
            out[i, j] = out[j, i] = v if v is not None else 0.0
        return out
    return _gram_arrow(x, k)


def _pair_sums(pairs) -> Column:
    """The sums of products as one array, parsed as one expression (thousands of column calls cost more than the pass)."""
    return F.expr("array(" + ", ".join(f"sum(u{i} * u{j})" for i, j in pairs) + ")")


def gram_by(df: DataFrame, group: Column, cols: Sequence[Column]) -> dict[int, np.ndarray]:
    """One Gram matrix per value of ``group`` (a few, such as folds) from one grouped aggregate."""
    k = len(cols)
    names = [f"u{i}" for i in range(k)]
    x = df.select(group.alias("g"), *[c.cast("double").alias(n) for c, n in zip(cols, names)])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    out = {}
    if len(pairs) <= JVM_GRAM_MAX_TERMS:
        for row in x.groupBy("g").agg(_pair_sums(pairs).alias("s")).collect():
            m = np.zeros((k, k))
            for v, (i, j) in zip(row["s"], pairs):
                m[i, j] = m[j, i] = v
            out[row["g"]] = m
        return out
    for g in [row["g"] for row in x.select("g").distinct().collect()]:
        out[g] = _gram_arrow(x.where(F.col("g") == g).drop("g"), k)
    return out


def _gram_arrow(x: DataFrame, k: int) -> np.ndarray:
    import pandas as pd

    def partial(batches):
        acc = np.zeros((k, k))
        for pdf in batches:
            m = pdf.to_numpy(dtype=np.float64, na_value=np.nan)
            acc += m.T @ m
        yield pd.DataFrame({"g": [acc.ravel()]})

    parts = x.mapInPandas(partial, "g array<double>")
    summed = (parts.select(F.posexplode("g").alias("pos", "v"))
              .groupBy("pos").agg(F.sum("v").alias("v")))
    out = np.zeros(k * k)
    for r in summed.collect():
        out[r["pos"]] = r["v"]
    return out.reshape(k, k)


def min_norm_solve(a: np.ndarray, b: np.ndarray, rcond: float = 1e-10) -> tuple[np.ndarray, int]:
    """Minimum-norm solution of the symmetric PSD system ``a w = b`` and its rank.

    ``a`` is a Gram matrix, so its eigenvalues are squared singular values of the
    design: ``rcond = 1e-10`` drops directions whose singular value is below 1e-5
    of the largest.  Exact collinearity (one-hot blocks, constant columns) gives
    eigenvalues at rounding level (~1e-16 relative), far below the cut; genuine
    but weak directions are kept.
    """
    if a.size == 0:
        return np.zeros(0), 0
    vals, vecs = np.linalg.eigh(a)
    top = max(vals.max(), 0.0)
    keep = vals > rcond * top if top > 0 else np.zeros_like(vals, dtype=bool)
    inv = np.zeros_like(vals)
    inv[keep] = 1.0 / vals[keep]
    return vecs @ (inv * (vecs.T @ b)), int(keep.sum())


def penalised_solve(a: np.ndarray, b: np.ndarray, penalty: float) -> tuple[np.ndarray, int]:
    """Solution of ``(a + penalty I) w = b`` and the rank; without a penalty the minimum-norm one."""
    if not penalty:
        return min_norm_solve(a, b)
    return np.linalg.solve(a + penalty * np.eye(len(a)), b), len(a)


def _complete_rows(train: DataFrame, fm: FeatureModel, target: str) -> DataFrame:
    complete = F.col(target).isNotNull()
    for c in fm.numeric:
        complete = complete & F.col(c).isNotNull()
    return train.where(complete)


def _design_gram(train: DataFrame, fm: FeatureModel, target: str) -> np.ndarray:
    """One pass: Gram of ``[1, pre-centred design..., y - mean]`` over complete training rows."""
    if fm.target_mean is None:
        raise ValueError("FeatureModel was fitted without the target; pass target= to fit_features")
    used = _complete_rows(train, fm, target)
    y = F.col(target).cast("double") - F.lit(fm.target_mean)
    g = gram(used, [F.lit(1.0)] + centred_design(fm, used) + [y])
    if g[0, 0] == 0:
        raise ValueError("no complete training rows to fit")
    return g


def _solve(g: np.ndarray, fm: FeatureModel, numeric: Sequence[str], categorical: Sequence[str],
           penalty: float = 0.0) -> LinearModel:
    """Least squares for the sub-design (``numeric`` + one-hot ``categorical``) of ``g``: minimum-norm, or with a ridge penalty."""
    slots, pos = {}, 1
    for c in fm.numeric:
        slots[c] = [pos]
        pos += 1
    for c in fm.categorical:
        slots[c] = list(range(pos, pos + len(fm.level_list(c))))
        pos += len(fm.level_list(c))
    y_slot = pos
    idx = [i for c in list(numeric) + list(categorical) for i in slots[c]]
    sub = g[np.ix_([0] + idx + [y_slot], [0] + idx + [y_slot])]
    n_used, sums = sub[0, 0], sub[0, 1:]
    cov = sub[1:, 1:] - np.outer(sums, sums) / n_used
    d = len(idx)
    w, rank = penalised_solve(cov[:d, :d], cov[:d, d], penalty * n_used)
    intercept = fm.target_mean + sums[d] / n_used - float(sums[:d] / n_used @ w)
    out_num, i = [], 0
    for c in numeric:
        out_num.append((c, fm.means[c], fm.scale(c), float(w[i])))
        i += 1
    n = float(fm.n_rows)
    out_cat = []
    for c in categorical:
        lw = []
        for lv in fm.level_list(c):
            lw.append((lv, float(w[i])))
            intercept -= float(w[i]) * fm.levels[c][lv] / n  # undo the pre-centring of the 0/1 column
            i += 1
        out_cat.append((c, lw))
    return LinearModel(float(intercept), out_num, out_cat, rank)


def fit_linear(train: DataFrame, fm: FeatureModel, target: str) -> LinearModel:
    """M1: OLS with intercept on the full encoding, minimum-norm (see module doc).

    Rows with a null target or a null numeric feature are left out (complete
    cases).  A constant column in the Gram pass gives the row count and column
    sums of the rows actually used, so the centring is exact for them even
    though the design was pre-centred with the training statistics.
    """
    return _solve(_design_gram(train, fm, target), fm, fm.numeric, fm.categorical)


def fit_linear_nested(train: DataFrame, fm: FeatureModel, target: str,
                      designs: dict[str, tuple[Sequence[str], Sequence[str]]]) -> dict[str, LinearModel]:
    """Several candidate models (feature subsets of ``fm``) from ONE pass over the data.

    Each candidate's centred Gram is a sub-block of the full design's, so model
    selection over nested feature sets costs one aggregate, not one per model.
    All candidates use the rows complete for the full design.
    """
    g = _design_gram(train, fm, target)
    return {name: _solve(g, fm, num, cat) for name, (num, cat) in designs.items()}


def fit_linear_ml(train: DataFrame, fm: FeatureModel, target: str) -> LinearModel:
    """M1 through Spark ML: ``LinearRegression(solver="normal")`` on a reference-coded design.

    The last level of each categorical is dropped (full rank when no other
    collinearity exists), then each categorical's level weights are centred to
    mean zero, which is the minimum-norm solution of the full one-hot design.
    Use ``fit_linear`` when the design may be rank deficient for other reasons.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    names, cols = [], []
    for c in fm.numeric:
        names.append(f"n{len(names)}")
        cols.append(fm.standardized(c).alias(names[-1]))
    kept = {}
    for c in fm.categorical:
        key = level_key(train, c)
        kept[c] = fm.level_list(c)[:-1]
        for lv in kept[c]:
            names.append(f"n{len(names)}")
            cols.append(F.when(key == F.lit(lv), F.lit(1.0)).otherwise(F.lit(0.0)).alias(names[-1]))
    complete = F.col(target).isNotNull()
    for c in fm.numeric:
        complete = complete & F.col(c).isNotNull()
    data = train.where(complete).select(F.col(target).cast("double").alias("_y"), *cols)
    data = VectorAssembler(inputCols=names, outputCol="_x").transform(data)
    m = LinearRegression(featuresCol="_x", labelCol="_y", solver="normal", regParam=0.0,
                         standardization=False, fitIntercept=True).fit(data)
    w = m.coefficients.toArray()
    intercept, i = float(m.intercept), 0
    numeric = []
    for c in fm.numeric:
        numeric.append((c, fm.means[c], fm.scale(c), float(w[i])))
        i += 1
    categorical = []
    for c in fm.categorical:
        levels = fm.level_list(c)
        block = [float(w[i + j]) for j in range(len(kept[c]))] + [0.0]
        i += len(kept[c])
        shift = sum(block) / len(block)
        intercept += shift
        categorical.append((c, [(lv, b - shift) for lv, b in zip(levels, block)]))
    return LinearModel(intercept, numeric, categorical, len(names))


# --- M2: Spark ML models over the vector encoding ----------------------------

def vector_pipeline(numeric: Sequence[str], categorical: Sequence[str], estimator=None):
    """Indexer (alphabetical, unseen kept) + one-hot (unseen slot dropped) + assembler."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler

    stages = []
    idx_out = [f"{c}__idx" for c in categorical]
    oh_out = [f"{c}__oh" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=idx_out,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=idx_out, outputCols=oh_out, dropLast=True,
                                    handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + oh_out, outputCol="features",
                                  handleInvalid="error"))
    if estimator is not None:
        stages.append(estimator)
    return Pipeline(stages=stages)


def gbt_regressor(target: str, **params):
    from pyspark.ml.regression import GBTRegressor

    return GBTRegressor(featuresCol="features", labelCol=target, predictionCol=PRED, **params)


def fit_gbt(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
            **params):
    """M2: gradient-boosted trees; returns a fitted ``PipelineModel``.

    As for least squares, rows with a null target or numeric are left out of the fit.
    """
    est = gbt_regressor(target, **params)
    rows = tree_inputs(train.where(F.col(target).isNotNull()), numeric, categorical).where("_complete")
    data = _sized(rows.select(*numeric, *categorical, F.col(target).cast("double").alias(target)))
    try:
        return vector_pipeline(numeric, categorical, est).fit(data)
    finally:
        data.unpersist()


def tree_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Columns as the tree pipeline takes them: numbers as double (null: 0, ``_complete`` false), levels as text."""
    complete = F.lit(True)
    for c in numeric:
        complete = complete & F.col(c).isNotNull()
    cols = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    cols |= {c: level_key(df, c) for c in categorical}
    return df.withColumn("_complete", complete).withColumns(cols)


def predict_tree(model, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """``df`` with ``y_pred`` (null where a numeric is null, as for the linear model)."""
    before = [c for c in df.columns]
    kept = df.select("*", *[F.col(c).alias(f"_in_{c}") for c in [*numeric, *categorical]])
    out = model.transform(tree_inputs(kept, numeric, categorical))
    back = [F.col(f"_in_{c}").alias(c) if c in numeric or c in categorical else F.col(c) for c in before]
    return out.select(*back, F.when(F.col("_complete"), F.col(PRED)).alias(PRED))


def predict(model, df: DataFrame, fm: FeatureModel) -> DataFrame:
    """``df`` with ``y_pred`` from a linear or a tree model."""
    if isinstance(model, LinearModel):
        return df.withColumn(PRED, model.predict_col(df))
    return predict_tree(model, df, fm.numeric, fm.categorical)


ROWS_PER_PARTITION = 250_000
MIN_ROWS = 10_000  # fewer rows than this are not worth a task of their own


def _sized(df: DataFrame) -> DataFrame:
    """Persist model-fit input with partitions sized by row count (not by input files).

    Boosting runs several jobs per round over this data; tiny partitions only add
    scheduling cost, so the partition count is the larger of the number of cores and
    ``rows / ROWS_PER_PARTITION``.
    """
    df = df.persist()
    n, largest = partition_rows(df)
    want = max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-n // MIN_ROWS)), -(-n // ROWS_PER_PARTITION))
    return repacked(df, want, largest)


def partition_rows(df: DataFrame) -> tuple[int, int]:
    """Rows of ``df``, and of its largest partition."""
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()


def repacked(df: DataFrame, want: int, largest: int) -> DataFrame:
    """The persisted ``df`` in ``want`` partitions where it has more, or where its largest is too much for one task.

    Partitions follow the input's files and row groups, however large these are; with more than
    twice ``ROWS_PER_PARTITION`` rows in one, the rows are dealt anew.
    """
    if largest > 2 * ROWS_PER_PARTITION:
        sized = df.repartition(want).persist()
    elif want < df.rdd.getNumPartitions():
        sized = df.coalesce(want).persist()
    else:
        return df
    sized.count()
    df.unpersist()
    return sized

"""Operator 10: toxicity categories by a classifier chain of linear models.

The categories are predicted one after the other; each logistic model sees the
text's features and the log-odds of all earlier categories.  While training,
those earlier log-odds are out-of-fold: every row's come from a model fitted
without that row's fold (equal texts are in one), so a later model learns from predictions as good as those
that it will get for new text.

Fitting uses a bounded sample of labelled rows (``SAMPLE_ROWS`` different ones, smallest
hashes first); everything else covers all rows.  Features are the presence of words, of
word beginnings (4, 5, 6 characters) and of runs of punctuation, in lower case; the
``N_FEATURES`` with the largest G-statistic over the categories are kept, counted on
the cluster.  The cut for a category maximises F1 on the out-of-fold predictions.

The labels table has one mark for toxicity and one for quality, so the default
categories are: junk (low quality), toxic junk, toxic.

Defined results: null text counts as empty; several labels of one id: a row is
toxic if any says so, and of low quality if any says so; a category without both
kinds of rows in the sample gets its constant rate and flags nothing; one
result row per row; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_broadcast, col, keep_rows, saved, text_hash

CATEGORIES = {"junk": "quality = 0", "toxic_junk": "toxic = 1 and quality = 0", "toxic": "toxic = 1"}
SAMPLE_ROWS = 20_000
N_FEATURES = 4000
FOLDS = 4
L2 = 1.0
ROUNDS = 120
BROADCAST_ROWS = 2_000_000
CACHE_WORDS = 300_000
LONG = 40            # characters; longer words are features by their digest
TOKEN = re.compile(r"\w+|[^\w\s]+")


def whole(word: str) -> str:
    """The word, or a digest of all of a very long one."""
    return word if len(word) <= LONG else "#" + hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def features_of(word: str) -> list[str]:
    """A word, its beginnings, or a run of punctuation."""
    if not (word[0].isalnum() or word[0] == "_"):
        return ["." + whole(word)]
    return ["=" + whole(word)] + ["^" + word[:n] for n in (4, 5, 6) if len(word) > n]


def words_of(text: str | None) -> set[str]:
    return set(TOKEN.findall((text or "").lower()))


def counted(sample: DataFrame, n_cat: int) -> DataFrame:
    """feature, n, pos (array): rows of ``sample`` (text, marks) with the feature, and by category."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def hand_on():
            names = list(held)
            for at in range(0, len(names), 20_000):
                part = names[at:at + 20_000]
                table = np.array([held[x] for x in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part)] + [pa.array(table[:, k]) for k in range(n_cat + 1)],
                    ["feature", "n"] + [f"p{k}" for k in range(n_cat)])
            held.clear()

        for b in batches:
            for t, m in zip(b.column(0), b.column(1).to_pylist()):
                row = np.array([1, *m], np.int64)
                for f in {f for w in words_of(t.as_py()) for f in features_of(w)}:
                    if f in held:
                        held[f] += row
                    else:
                        held[f] = row.copy()
            if len(held) > 500_000:
                yield from hand_on()
        yield from hand_on()

    cols = ", ".join(f"p{k} long" for k in range(n_cat))
    found = sample.mapInArrow(run, f"feature string, n long, {cols}")
    return found.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(f"p{k}").alias(f"p{k}") for k in range(n_cat)])


def chosen(counts: DataFrame, totals: list[int], n_rows: int, n_features: int) -> list[str]:
    """The features with the largest G-statistic in any category (ties by name)."""

    def g(k):
        a, n, t = F.col(f"p{k}").cast("double"), F.col("n").cast("double"), float(totals[k])
        cells = [(a, n * t / n_rows), (n - a, n * (n_rows - t) / n_rows), (t - a, (n_rows - n) * t / n_rows),
                 (n_rows - t - n + a, (n_rows - n) * (n_rows - t) / n_rows)]
        return sum((F.when((x > 0) & (e > 0), x * F.log(x / e)).otherwise(0.0) for x, e in cells), F.lit(0.0))

    score = F.greatest(*[g(k) for k in range(len(totals))], F.lit(0.0))
    top = (counts.where("n >= 3").select("feature", score.alias("g")).where("g > 3")
           .orderBy(F.desc("g"), "feature").limit(n_features))
    return [r["feature"] for r in top.select("feature").collect()]


class Rows:
    """Presence features of rows in compressed form, plus dense extra columns."""

    def __init__(self, lists: list[np.ndarray], width: int):
        self.row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        self.at = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
        self.n, self.width = len(lists), width

    def dot(self, w: np.ndarray, extra: np.ndarray) -> np.ndarray:
        k = extra.shape[1]
        return np.bincount(self.row, w[self.at], self.n) + extra @ w[self.width:self.width + k] + w[-1]

    def grad(self, g: np.ndarray, extra: np.ndarray) -> np.ndarray:
        return np.r_[np.bincount(self.at, g[self.row], self.width), extra.T @ g, g.sum()]


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(x: Rows, extra: np.ndarray, y: np.ndarray, on: np.ndarray, l2: float = L2, rounds: int = ROUNDS) -> np.ndarray:
    """Logistic regression by accelerated gradient steps with a diagonal bound on the curvature."""
    n_w = x.width + extra.shape[1] + 1
    rate = np.clip(y[on].mean(), 1e-4, 1 - 1e-4)
    w = np.zeros(n_w)
    w[-1] = np.log(rate / (1 - rate))
    # row sums of |x| bound the curvature of each coordinate
    size = np.bincount(x.row, minlength=x.n) + np.abs(extra).sum(axis=1) + 1
    weight = np.where(on, size, 0)
    curve = 0.25 * np.r_[np.bincount(x.at, weight[x.row], x.width), np.abs(extra).T @ weight, weight.sum()] + l2
    v, t = w, 1.0
    for _ in range(rounds):
        g = np.where(on, sigmoid(x.dot(v, extra)) - y, 0.0)
        step = x.grad(g, extra) + l2 * np.r_[v[:-1], 0]
        new = v - step / curve
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from which flagging maximises F1."""
    order = np.argsort(-p, kind="stable")
    p, y = p[order], y[order]
    hit, last = np.cumsum(y), np.r_[p[1:] != p[:-1], True]
    f1 = np.where(last, 2 * hit / (np.arange(1, len(p) + 1) + y.sum()), -1)
    k = int(f1.argmax())
    return float((p[k] + (p[k + 1] if k + 1 < len(p) else 0)) / 2)


def chain(x: Rows, marks: np.ndarray, fold: np.ndarray) -> list[dict]:
    """Per category: weights (None: constant), cut, rate, and out-of-fold scores for the report."""
    extra, out = np.zeros((x.n, 0)), []
    for k in range(marks.shape[1]):
        y = marks[:, k].astype(float)
        folds = [f for f in np.unique(fold) if 0 < y[fold != f].sum() < (fold != f).sum()]
        if not len(y) or not 0 < y.sum() < len(y) or len(folds) < len(np.unique(fold)) or len(folds) < 2:
            rate = float(y.mean()) if len(y) else 0.0
            out.append({"w": None, "cut": np.inf, "rate": rate})
            extra = np.c_[extra, np.zeros(x.n)]
            continue
        z = np.zeros(x.n)
        for f in folds:
            w = fit(x, extra, y, fold != f)
            z = np.where(fold == f, x.dot(w, extra), z)
        z = np.clip(z, -8, 8)
        p = sigmoid(z)
        cut = best_cut(p, y)
        flag = p >= cut
        out.append({"w": fit(x, extra, y, np.ones(x.n, bool)), "cut": cut, "rate": float(y.mean()),
                    "precision": float(y[flag].mean()), "recall": float(y[flag].sum() / y.sum())})
        extra = np.c_[extra, z]
    return out


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", categories: dict | None = None,
          sample_rows: int = SAMPLE_ROWS, n_features: int = N_FEATURES) -> dict:
    """The chain: features, models, category names."""
    cats = categories or CATEGORIES
    marks = labels.where(col(id_col).isNotNull()).groupBy(col(id_col).alias("l_id")).agg(
        *[F.max(F.coalesce(F.expr(e), F.lit(False)).cast("int")).alias(f"m{k}") for k, e in enumerate(cats.values())])
    marks = saved(marks.orderBy(F.xxhash64("l_id"), "l_id").limit(sample_rows), "toxicity-labels")
    sample = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).join(
        bounded_broadcast(marks, BROADCAST_ROWS), F.col("id") == F.col("l_id"))
    # several rows may have one id: at most sample_rows of them, equal ones once
    keys = sample.select(F.col("id").alias("k_id"), text_hash("text").alias("k_hash")).distinct()
    keys = saved(keys.orderBy(F.xxhash64("k_id", "k_hash"), "k_id", "k_hash").limit(sample_rows), "toxicity-keys")
    sample = keep_rows(sample, keys, "id", "text", once=True)
    sample = saved(sample.select("id", "text", F.array(*[f"m{k}" for k in range(len(cats))]).alias("marks")),
                   "toxicity-sample")
    n_rows, *totals = sample.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(F.col("marks")[k]), F.lit(0))
                                                      for k in range(len(cats))]).first()
    names = chosen(counted(sample.select("text", "marks"), len(cats)), totals, n_rows, n_features) if n_rows else []
    index = {f: i for i, f in enumerate(names)}
    given = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for b in batches:
            lists = [sorted({given.value[f] for w in words_of(t.as_py()) for f in features_of(w) if f in given.value})
                     for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), b.column(1), b.column(2)],
                                             ["at", "marks", "fold"])

    # at most sample_rows rows of feature numbers
    data = sample.select("text", "marks", F.pmod(text_hash("text"), F.lit(FOLDS)).alias("fold")).mapInArrow(
        run, "at array<int>, marks array<int>, fold long").toArrow()
    x = Rows([np.array(v, np.int64) for v in data.column(0).to_pylist()], len(names))
    y = np.array(data.column(1).to_pylist(), np.int64).reshape(x.n, len(cats))
    return {"index": index, "names": list(cats), "models": chain(x, y, np.array(data.column(2).to_pylist()))}


def predict(docs: DataFrame, model: dict, id_col="doc_id", text_col="text") -> DataFrame:
    """Per row: id, for each category p_<name> and <name> (flag)."""
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    given = docs.sparkSession.sparkContext.broadcast(model)  # at most n_features features
    id_type = src.schema["id"].simpleString().split(":", 1)[1]
    names = model["names"]

    def run(batches):
        index, models = given.value["index"], given.value["models"]
        known: dict[str, tuple] = {}

        class Known(dict):
            def __missing__(self, w):
                if len(self) > CACHE_WORDS:
                    self.clear()
                out = self[w] = tuple(index[f] for f in features_of(w) if f in index)
                return out

        known = Known()
        for b in batches:
            lists = []
            for t in b.column(1):
                hits = set()
                for f in map(known.__getitem__, words_of(t.as_py())):
                    if f:
                        hits.update(f)
                lists.append(np.fromiter(hits, np.int64, len(hits)))
            x, extra, out = Rows(lists, len(index)), np.zeros((b.num_rows, 0)), []
            for m in models:
                z = np.zeros(b.num_rows) if m["w"] is None else np.clip(x.dot(m["w"], extra), -8, 8)
                p = np.full(b.num_rows, m["rate"]) if m["w"] is None else sigmoid(z)
                out += [pa.array(p), pa.array(p >= m["cut"])]
                extra = np.c_[extra, z]
            yield pa.RecordBatch.from_arrays([b.column(0), *out], ["id", *(f for n in names for f in (f"p_{n}", n))])

    cols = ", ".join(f"`p_{n}` double, `{n}` boolean" for n in names)
    return src.mapInArrow(run, f"id {id_type}, {cols}")


def toxicity(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", **options) -> DataFrame:
    return predict(docs, train(docs, labels, id_col, text_col, **options), id_col, text_col)

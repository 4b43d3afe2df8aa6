from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparktab.llm import neighbours, passages, toxicity

from .conftest import invented


# --- nearest neighbours ---------------------------------------------------------------------------------------------

def brute(ids, x, is_query, k):
    out = {}
    for i in np.flatnonzero(is_query):
        s = x @ x[i]
        at = [j for j in np.lexsort((ids, -s)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in at]
    return out


@pytest.mark.parametrize("same", [False, True])
def test_recall_and_scores(spark, same):
    rng = np.random.default_rng(1)
    n = 1500
    x = rng.normal(size=(n, 12)) * rng.uniform(0.5, 2, size=(n, 1))
    if same:
        x[: n // 3] = x[0]  # a third of all rows in one leaf
    ids = rng.permutation(n)
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)],
                               "vec_id long, embedding array<double>, id int").repartition(4)
    report = {}
    got = neighbours.search(df, F.col("id") % 20 == 0, leaf_rows=60, chunk=50, calibration=60, report=report).collect()
    want = brute(ids, x, ids % 20 == 0, 20)
    assert report["leaves"] > 4
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hits = 0
    for q, best in want.items():
        rows = sorted(by[q], key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        i = int(np.flatnonzero(ids == q)[0])
        for r in rows:
            assert r.score == pytest.approx(float(x[i] @ x[int(np.flatnonzero(ids == r.vec_id)[0])]), abs=1e-12)
        hits += sum(r.score >= best[-1][1] - 1e-12 for r in rows)
    assert hits / (20 * len(want)) >= 0.9


def test_equal_vectors_score_equally_across_chunks(spark):
    """Copies of vectors in different blocks, rows and chunks: equal scores, ordered by id."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1000, 64))
    x = np.r_[x, x[:200]]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, id int").repartition(5)
    got = neighbours.search(df, F.col("id") % 3 == 0, leaf_rows=100, chunk=37, calibration=40).toPandas()
    seen = 0
    for _, g in got.sort_values(["query_id", "rank"]).groupby("query_id"):
        ids, scores = g.vec_id.tolist(), g.score.tolist()
        for a, b, u, v in zip(ids, ids[1:], scores, scores[1:]):
            if a % 1000 == b % 1000 and max(a, b) >= 1000:
                seen += 1
                assert u == v and a < b
    assert seen > 100


def test_outliers_get_k_neighbours(spark):
    """One dense cluster and scattered outliers, whose leaves hold few rows."""
    rng = np.random.default_rng(3)
    x = np.r_[1 + rng.normal(size=(1960, 8)) * 0.01, rng.normal(size=(40, 8)) * 30]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)],
                               "vec_id long, embedding array<double>, id int").repartition(4)
    report = {}
    got = neighbours.search(df, (F.col("id") % 20 == 0) | (F.col("id") >= 1960), leaf_rows=60, recall=0.5,
                            report=report).groupBy("query_id").count().collect()
    assert report["visits"] < report["leaves"]
    assert {r.query_id: r["count"] for r in got} == {i: 20 for i in range(2000) if i % 20 == 0 or i >= 1960}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (20, [0.5, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]),
            (4, [inf, 1.0]), (5, [1.0, None]), (6, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [0.0, 2.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.search(df, F.col("id") % 20 == 0)
           .orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 0.5), (0, 2, 7, 0.0), (20, 1, 7, 1.0), (20, 2, 0, 0.5)]
    assert neighbours.search(df.where("vec_id = 1"), F.col("id") % 20 == 0).count() == 0
    assert neighbours.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


# --- passages -------------------------------------------------------------------------------------------------------

def test_chains_equal_brute_force():
    """Best chain score by Fenwick tree against the quadratic recurrence."""
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(1, 14)
        frag = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(n)})
        size = [rng.randint(3, 9) for _ in frag]
        pos, rpos = (np.array(c) for c in zip(*frag))
        found = passages.chains(pos, rpos, np.array(size))
        assert sorted(itertools.chain(*found)) == list(range(len(frag)))

        def score(path):
            s = sum(size[i] for i in path)
            for a, b in zip(path, path[1:]):
                da, db = pos[b] - pos[a] - size[a], rpos[b] - rpos[a] - size[a]
                assert da >= 0 and db >= 0
                s -= passages.GAP * (da + db)
            return s

        best = [0.0] * len(frag)
        for i in sorted(range(len(frag)), key=lambda i: (pos[i], rpos[i])):
            before = [best[j] - passages.GAP * (pos[i] - pos[j] - size[j] + rpos[i] - rpos[j] - size[j])
                      for j in range(len(frag)) if pos[j] + size[j] <= pos[i] and rpos[j] + size[j] <= rpos[i]]
            best[i] = size[i] + max([0.0, *before])
        assert score(found[0]) == pytest.approx(max(best))


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert passages.common(a, b) == t[-1][-1]


def test_planted_passages(spark):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared, fuzzy, short = words(60), words(90), words(30)
    rows, want = [], {}
    for i in range(40):
        w = words(rng.randint(80, 200))
        at = rng.randint(0, len(w))
        if i % 4 == 1:
            w[at:at] = shared
            want[i] = (at, at + 60)
        elif i % 4 == 2:
            f = list(fuzzy)
            for _ in range(3):
                f[rng.randrange(90)] = rng.choice(vocab)
            del f[rng.randrange(len(f))]
            w[at:at] = f
            want[i] = (at, at + 89)
        elif i % 4 == 3:
            w[at:at] = short
        rows.append((i, " ".join(w)))
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    firsts = {1, 2}
    assert {r.id for r in got} == set(want) - firsts
    for r in got:
        assert r.ref_id < r.id and r.ref_id % 4 == r.id % 4
        assert abs(r.start - want[r.id][0]) <= 3 and abs(r.stop - want[r.id][1]) <= 3
        assert r.identity >= 0.8


def test_alignment_places_are_a_longest_common_subsequence(monkeypatch):
    rng = random.Random(4)
    for area in (1 << 28, 12):
        monkeypatch.setattr(passages, "AREA", area)
        for _ in range(100):
            a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 14))] for _ in range(2))
            got = passages.matched(a, b)
            assert len(got) == passages.common(a, b) and all(a[i] == b[j] for i, j in got)
            assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


def test_two_passages_of_a_pair(spark):
    """A shared header and footer around other words; a passage with a stock phrase further on."""
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    head, foot, body, stock = words(60), words(60), words(60), words(16)
    rows = [(i, " ".join(head + words(100) + foot)) for i in (1, 2)]
    rows += [(i, " ".join(words(20) + body + words(25) + stock + words(20))) for i in (3, 4)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted((r.id, r.ref_id) for r in got) == [(2, 1), (2, 1), (4, 3)]
    for r, (start, stop) in zip(sorted(got, key=lambda r: (r.id, r.start)), [(0, 60), (160, 220), (20, 80)]):
        assert abs(r.start - start) <= 3 and abs(r.stop - stop) <= 3
        assert abs(r.ref_start - start) <= 3 and abs(r.ref_stop - stop) <= 3 and r.identity >= 0.8


@pytest.mark.parametrize("every", [5, 7, 10])
def test_regular_edits(spark, every):
    """One word in ``every`` replaced: identity 0.8, 0.86 and 0.9."""
    rng = random.Random(every)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = []
    for i in range(0, 20, 2):
        base = words(80)
        edited = [rng.choice(vocab) if j % every == every - 2 else w for j, w in enumerate(base)]
        rows += [(i, " ".join(words(70) + base + words(50))), (i + 1, " ".join(words(60) + edited + words(90)))]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert {(r.id, r.ref_id) for r in got} == {(i + 1, i) for i in range(0, 20, 2)}
    assert all(abs(r.start - 60) <= 12 and abs(r.stop - 140) <= 12 and r.identity >= 0.8 for r in got)


def test_every_shared_window_is_found(spark):
    """Whole copies, and a third of all rows in one group: each later copy is covered."""
    rng = random.Random(9)
    base = invented(rng, 150)
    rows = [(i, base if i % 3 == 0 else invented(rng, 120)) for i in range(60)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r.id for r in got} == {i for i in range(3, 60, 3)}
    assert all((r.start, r.stop, r.ref_start, r.ref_stop, r.identity) == (0, 150, 0, 150, 1.0) for r in got)


def test_odd_documents(odd, nothing):
    got = passages.passages(odd)
    assert {(2, 1), (3, 1)} <= {(r.id, r.ref_id) for r in got.collect()}
    assert passages.passages(nothing).count() == 0


# --- toxicity -------------------------------------------------------------------------------------------------------

def toxic_table(spark, n=600):
    rng = random.Random(7)
    rows, marks = [], []
    for i in range(n):
        t = invented(rng, 40).split()
        toxic, junk = int(i % 5 == 0), int(i % 7 == 0)
        if toxic:
            t[rng.randrange(40)] = rng.choice(["grimblor", "vexnak", "sludrot"])
        if junk:
            t = [w + "###" for w in t]
        rows.append((i, " ".join(t)))
        marks.append((i, 1 - junk, toxic))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), marks)


def test_held_out_accuracy(spark):
    docs, labels, marks = toxic_table(spark)
    out = {r.id: r for r in toxicity.toxicity(docs, labels.where("doc_id < 400")).collect()}
    assert len(out) == 600
    for i, quality, toxic in marks[400:]:
        assert out[i].toxic == bool(toxic), i
        assert out[i].junk == (quality == 0), i
        assert 0 <= out[i].p_toxic_junk <= 1


def test_later_models_use_earlier_categories():
    """The second label is a noisy copy of the first, with no features of its own."""
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2, 400)
    b = np.where(rng.random(400) < 0.1, 1 - a, a)
    x = toxicity.Rows([np.array([0]) if v else np.array([1]) for v in a], 2)
    models = toxicity.chain(x, np.c_[a, b], np.arange(400) % 4)
    assert models[1]["w"][2] > 0.05  # weight of the first category's log-odds
    assert models[0]["recall"] == 1.0 and 0.8 < models[1]["precision"] < 1.0


def test_logistic_fit_is_the_optimum():
    rng = np.random.default_rng(1)
    lists = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(200)]
    x = toxicity.Rows(lists, 6)
    y = (rng.random(200) < np.array([0.2 + 0.5 * (0 in v) for v in lists])).astype(float)
    extra = rng.normal(size=(200, 1))
    w = toxicity.fit(x, extra, y, np.ones(200, bool), rounds=4000)
    g = x.grad(toxicity.sigmoid(x.dot(w, extra)) - y, extra) + np.r_[w[:-1], 0]
    assert np.abs(g).max() < 1e-3


def test_toxicity_of_odd_documents(odd, odd_rows, labels, nothing, no_labels):
    assert toxicity.toxicity(odd, labels).count() == len(odd_rows)
    assert toxicity.toxicity(odd, no_labels).where("toxic").count() == 0
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_long_tokens_stay_different_and_copies_share_a_fold(spark, monkeypatch):
    a, b = "x" * 100 + "a", "x" * 100 + "b"
    assert toxicity.features_of(a)[0] != toxicity.features_of(b)[0] and len(toxicity.features_of(a * 1000)[0]) < 50
    assert toxicity.features_of("!!!!") != toxicity.features_of("!!!")
    docs, labels, _ = toxic_table(spark)
    docs = docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).unionByName(docs.limit(5))
    labels = labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 1000))
    seen = {}
    plain = toxicity.chain

    def chain(x, y, fold):
        seen["rows"] = len(fold)
        seen["folds"] = {}
        for i, f in enumerate(fold):
            seen["folds"].setdefault(tuple(sorted(x.at[x.row == i].tolist())), set()).add(int(f))
        return plain(x, y, fold)

    monkeypatch.setattr(toxicity, "chain", chain)
    toxicity.train(docs, labels, sample_rows=900)
    assert seen["rows"] <= 900
    toxicity.train(docs, labels)
    assert seen["rows"] == 1200  # equal rows of one id count once
    copies = [f for at, f in seen["folds"].items() if len(at) > 5]
    assert copies and all(len(f) == 1 for f in copies)


def test_blocks_hold_seeds_and_links(spark):
    """What the tasks hand on is packed: a row per bucket, not one per seed, and some 10 bytes a seed."""
    rng = np.random.default_rng(5)
    rows = [(10 ** 12 + i, " ".join(map(str, rng.integers(0, 10 ** 9, 400)))) for i in range(150)]
    rows += [(7, rows[3][1])]
    table = passages.seed_table(spark.createDataFrame(rows, "id long, text string").coalesce(1), passages.K, passages.WINDOW)
    got = table.toPandas()
    assert len(got) <= 2 * 4096 and set(got.kind) == {0, 1}
    back = [passages.seeds_of(r.size_, pa.scalar(r.rows)) for r in got[got.kind == 0].rename(columns={"size": "size_"}).itertuples()]
    h, doc, pos, size, seg = (np.concatenate(c) for c in zip(*back))
    want = {}
    for i, t in sorted(rows):
        w = passages.word_hashes(t)
        long_, short = passages.seeds(w), passages.short_seeds(w)
        for x, p, n, g in (*zip(*long_), *zip(*short)):
            want.setdefault(int(x), (i, int(p), int(n), max(int(g) & 0xFFFFFFFF, 1) if n != 4 or int(g) else 0))
    assert dict(zip(h.tolist(), zip(doc.tolist(), pos.tolist(), size.tolist(), seg.tolist()))) == want
    links = [passages._unblock(n, pa.scalar(r)) for n, r in got[got.kind == 1][["size", "rows"]].itertuples(index=False)]
    doc, pos, ref, rpos, size = (np.concatenate(c).tolist() for c in zip(*links))
    assert (doc, pos, ref, rpos, size) == ([rows[3][0]], [0], [7], [0], [400])
    h = np.sort(rng.integers(0, 2 ** 52, 3000).astype(np.uint64))  # a bucket of a full lot
    block = next(passages.seed_blocks(h, rng.integers(0, 9000, 3000), rng.integers(0, 700, 3000), np.full(3000, 4),
                                      np.zeros(3000, np.uint32)))
    assert len(block.column(3)[0].as_py()) < 11 * 3000
    odd = [np.array(c, np.int64) for c in ([2 ** 63 - 1, -2 ** 63, 0], [], [5])]
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(passages.unpack(passages.pack(*odd)), odd))


def test_seeds_of_many_texts_at_once(spark, monkeypatch):
    """Texts are seeded in lots, not one by one, with the seeds that each has by itself."""
    rng = np.random.default_rng(8)
    sizes = [0, 3, 4, 7, 8, 9, 18, 19, 20, 21, 300, 0, 40, 1]
    texts = [" ".join(rng.choice(["a", "B", "c\x1cd", "é"], n)) for n in sizes]
    texts[4] = "\n " + texts[4] + "\t"
    words, off = passages.text_words(pa.array(texts))
    each = [t.encode().lower().split() for t in texts]
    assert np.diff(off).tolist() == [len(w) for w in each]
    of_word = dict(zip([w for ws in each for w in ws], words.tolist()))
    assert words.tolist() == [of_word[w] for ws in each for w in ws] and len(set(of_word.values())) == len(of_word)
    k, window = 8, 12
    want = []
    for lo, hi in zip(off[:-1], off[1:]):
        h = passages.kmers(words[lo:hi], k).tolist()
        tops = [range(i, i + window) for i in range(len(h) - window + 1)] or ([range(len(h))] if h else [])
        pos = sorted({min(r, key=lambda i: (h[i], i)) for r in tops})
        for p, q in zip(pos, [*pos[1:], int(hi - lo)]):
            parts = passages.mix(words[lo + p:lo + q] + np.arange(q - p).astype(np.uint64) * passages.BASE)
            want.append((h[p], int(lo) + p, q - p, int(parts.sum())))
    got = passages.seeds(words, k, window, off)
    assert list(zip(*(c.tolist() for c in got))) == want and len(want) > 30
    h, pos, n, seg = passages.short_seeds(words, 4, off)
    assert pos.tolist() == [p for lo, hi in zip(off[:-1], off[1:]) for p in range(lo, hi - 3)]
    assert all(h[i] == passages.short_seeds(words[p:p + 4])[0][0] for i, p in enumerate(pos.tolist()))
    lots = passages.lots(pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array(["x" * (1 << 21)] * 2 + ["y"])], ["id", "text"]))
    assert [lot.column(0).to_pylist() for lot in lots] == [[0], [1, 2]]

    class Direct:  # the function that the tasks run
        def mapInArrow(self, run, schema):
            return run

    calls = []
    monkeypatch.setattr(passages, "kmers", lambda *a, real=passages.kmers: calls.append(1) or real(*a))
    batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([texts[10]] * 200)], ["id", "text"])
    assert list(passages.seed_table(Direct(), k, window)([batch])) and len(calls) == 2


def test_alignment_passes_over_words_of_one_side():
    a, b = [1, 9, 2, 8, 3], [7, 1, 2, 6, 2, 3]
    assert passages.matched(a, b) == [(0, 1), (2, 2), (4, 5)] and passages.matched([1], [2]) == []
    rows = passages.lists(pa.array([[1, 2], [], [3]], pa.list_(pa.int32())))
    assert list(rows) == [[1, 2], [], [3]]

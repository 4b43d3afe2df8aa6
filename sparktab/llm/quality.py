"""Operator 2: quality filter by an interpolated modified Kneser-Ney n-gram model.

The model is over UTF-8 bytes, one per language, trained on trusted text (rows
that ``labels`` marks as good; one fold in ten is held out for the threshold; a language
without held-out text has its trusted texts scored out of fold, by ``FOLDS`` models more).
All of the corpus is counted: each task folds its texts into (language, n-gram)
counts, and Spark adds them up.  Continuation counts, discounts, context weights
and the interpolated probabilities are joins and aggregates between those count
tables, sharded by n-gram; they are made for every n-gram that occurs in any
document, so nothing is unseen when documents are scored.  The probability table is then cut
into hash shards of about ``shard_rows`` n-grams; each shard (a fixed bound of
16 bytes a row) goes to the tasks once, and every document's partial sums are
added up over the shards.  More corpus means more shards, never a cut-off.

A document's score is its bits per byte, with ``prior`` bytes at the language's mean
added so that a text of a few words is not judged on them alone.  A document is
rejected when its score lies above ``margin`` + the ``quantile`` of the held-out
trusted documents of its language.

Defined results: null language is a language of its own; a language without
trusted text rejects nothing; null and empty texts have no perplexity
and are rejected; rows with equal id and text get the same decision; labels may
repeat (one bad label makes a document untrusted) or be empty; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, col, discard, keep_rows, saved, text_hash

ORDER = 5
QUANTILE = 0.995
MARGIN = 0.25
PRIOR = 200
FOLDS = 5           # of the trusted texts of a language without held-out ones
SHARD_ROWS = 2_000_000
LABEL_BROADCAST_ROWS = 2_000_000
LANGUAGE_BROADCAST_ROWS = 100_000
PAD = 0xFF          # never occurs in UTF-8
SYMBOLS = 256
CHUNK = 1 << 21     # bytes of a text worked on at once
WORK = 1 << 20      # bytes of shorter texts worked on at once (each byte takes some 50 in arrays)
FLUSH = 3_000_000   # n-grams a task holds before it hands them on


def grams(texts: list[bytes], order: int):
    """Yield (codes, text index) of all n-grams, about WORK bytes at a time."""
    lead = bytes([PAD]) * (order - 1)
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t), CHUNK):
            piece = (t[at - order + 1:at] if at else lead) + t[at:at + CHUNK]
            held.append((i, piece))
            size += len(piece)
            if size >= WORK:
                yield _codes(held, order)
                held, size = [], 0
    if held:
        yield _codes(held, order)


def _codes(pieces, order):
    whole = np.frombuffer(b"".join(p for _, p in pieces), np.uint8).astype(np.uint64)
    sizes = np.fromiter((len(p) for _, p in pieces), np.int64, len(pieces))
    n = len(whole) - order + 1
    code = np.zeros(n, np.uint64)
    for k in range(order):
        code = code << np.uint64(8) | whole[k:k + n]
    # an n-gram belongs to the piece it ends in, and must lie in it whole
    offset = np.arange(len(whole)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = offset[order - 1:] >= order - 1
    doc = np.repeat(np.fromiter((i for i, _ in pieces), np.int64, len(pieces)), sizes)[order - 1:]
    return code[inside], doc[inside]


def _by_group(batch, key_cols: list[int], text_col: int):
    """Rows of a batch by key: {key: (row numbers, texts as bytes)}."""
    keys = list(zip(*(batch.column(k).to_pylist() for k in key_cols)))
    groups: dict[tuple, tuple[list[int], list[bytes]]] = {}
    for i, (k, t) in enumerate(zip(keys, batch.column(text_col))):
        rows, texts = groups.setdefault(k, ([], []))
        rows.append(i)
        texts.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
    return groups


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, code, n, t): occurrences in all documents and in the training ones; ``docs``: lang, train, text."""

    def run(batches):
        held: dict[tuple, list] = {}
        size = 0

        def fold(key):
            parts = held.pop(key)
            code = np.concatenate([c for c, _ in parts])
            n = np.concatenate([x for _, x in parts])
            del parts
            order_ = np.argsort(code, kind="stable")
            code, n = code[order_], n[order_]
            del order_
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
            held[key] = [(code[first], np.add.reduceat(n, first))]

        def hand_on():
            for key in list(held):
                fold(key)
                code, n = held.pop(key)[0]
                lang, train = key
                for at in range(0, len(code), 1 << 16):
                    c, k = code[at:at + (1 << 16)].view(np.int64), n[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(c), lang)), pa.array(c), pa.array(k), pa.array(k * int(train))],
                        ["lang", "code", "n", "t"])

        for b in batches:
            for key, (_, texts) in _by_group(b, [0, 1], 2).items():
                for code, _ in grams(texts, order):
                    c, n = np.unique(code, return_counts=True)
                    held.setdefault(key, []).append((c, n))
                    size += len(c)
            if size > FLUSH:
                for key in list(held):
                    fold(key)
                size = sum(len(p[0][0]) for p in held.values())
                if size > FLUSH:
                    yield from hand_on()
                    size = 0
        yield from hand_on()

    return (docs.mapInArrow(run, "lang long, code long, n long, t long")
            .groupBy("lang", "code").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))


def _mask(n: int) -> int:
    return (1 << 8 * n) - 1


def _per_language(df: DataFrame) -> DataFrame:
    """A table of one narrow row per language, broadcast below a checked number, so that no language meets in one task."""
    return bounded_broadcast(saved(df, "per-language"), LANGUAGE_BROADCAST_ROWS)


def discounts(counts: DataFrame) -> DataFrame:
    """Per language the three discounts d1, d2, d3 from the counts of counts."""
    k = [F.sum((F.col("c") == i).cast("long")).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))

    def d(i):  # without counts of counts (small corpora): half a count
        raw = F.when((F.col("n1") > 0) & (F.col(f"n{i}") > 0),
                     i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))
        return F.least(F.greatest(F.coalesce(raw, F.lit(0.5)), F.lit(0.05)), F.lit(i - 0.05)).alias(f"d{i}")

    return counts.groupBy("lang").agg(*k).select("lang", d(1), d(2), d(3))


def probabilities(types: DataFrame, order: int) -> DataFrame:
    """(lang, code, bits): -log2 of the interpolated modified Kneser-Ney probability of every n-gram type."""
    counts = {order: types.where("t > 0").select("lang", "code", F.col("t").alias("c"))}
    for n in range(order - 1, 0, -1):  # continuation counts: distinct left extensions
        counts[n] = saved(counts[n + 1].groupBy("lang", F.col("code").bitwiseAND(F.lit(_mask(n))).alias("code"))
                          .agg(F.count(F.lit(1)).alias("c")), f"kn-counts{n}")
    lower = None
    for n in range(1, order + 1):
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        cut = counts[n].join(_per_language(discounts(counts[n])), "lang").withColumn("d", d)
        context = F.shiftrightunsigned("code", 8).alias("context")
        weight = cut.groupBy("lang", context).agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        own = cut.select("lang", "code", F.greatest(F.col("c") - F.col("d"), F.lit(0.0)).alias("rest"))
        asked = types.select("lang", F.col("code").bitwiseAND(F.lit(_mask(n))).alias("code"))
        asked = (asked if n == order else asked.distinct()).withColumn("context", F.shiftrightunsigned("code", 8))
        p = asked.join(own, ["lang", "code"], "left").join(weight, ["lang", "context"], "left")
        if lower is None:
            p = p.withColumn("q", F.lit(1.0 / SYMBOLS))
        else:
            p = p.withColumn("suffix", F.col("code").bitwiseAND(F.lit(_mask(n - 1))))
            p = p.join(lower.select("lang", F.col("code").alias("suffix"), F.col("p").alias("q")), ["lang", "suffix"])
        p = p.select("lang", "code", F.coalesce(
            F.coalesce(F.col("rest"), F.lit(0.0)) / F.col("total") + F.col("gamma") * F.col("q"), F.col("q")).alias("p"))
        lower = saved(p, f"kn-p{n}")
    discard(*(counts[n] for n in range(1, order)))
    return lower.select("lang", "code", (-F.log2("p")).alias("bits"))


def partial_scores(docs: DataFrame, shard, order: int) -> DataFrame:
    """Bits and bytes of each document's n-grams that lie in the shard (a broadcast {lang: (codes, bits)})."""
    id_type = docs.schema["id"].simpleString().split(":", 1)[1]

    def run(batches):
        table = shard.value
        for b in batches:
            bits, n = np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for (lang,), (rows, texts) in _by_group(b, [2], 3).items():
                if lang not in table:
                    continue
                codes, cost = table[lang]
                rows = np.array(rows)
                for code, doc in grams(texts, order):
                    pos = np.searchsorted(codes, code)
                    np.minimum(pos, len(codes) - 1, out=pos)
                    hit = codes[pos] == code
                    k = len(rows)
                    bits[rows] += np.bincount(doc[hit], cost[pos[hit]], k)
                    n[rows] += np.bincount(doc[hit], minlength=k)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(bits), pa.array(n)],
                                             ["id", "text_hash", "lang", "bits", "n"])

    return docs.mapInArrow(run, f"id {id_type}, text_hash long, lang long, bits double, n long")


def fold_lang(number: str):
    """The language that the model of a fold goes by."""
    return F.xxhash64("lang", F.col(number))


def fold(good: DataFrame, held_out) -> DataFrame:
    """(id, text_hash, lang, fold) of the trusted texts of languages without held-out ones; equal texts are in one fold."""
    none = good.groupBy("lang").agg(F.max(held_out.cast("int")).alias("held")).where("held = 0").select("lang")
    place = F.dense_rank().over(Window.partitionBy("lang").orderBy("text_hash"))
    return (good.distinct().join(bounded_broadcast(saved(none, "unheld"), LANGUAGE_BROADCAST_ROWS), "lang")
            .select("id", "text_hash", "lang", F.pmod(place - 1, F.lit(FOLDS)).alias("fold")))


def scores(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
           quality_col="quality", order: int = ORDER, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Per (id, text_hash): lang (hash), bits, n (bytes), trusted, held_out, and held_bits, held_n by a model without the text."""
    spark = docs.sparkSession
    trust = (labels.groupBy(col(id_col).alias("l_id")).agg(F.min(col(quality_col)).alias("q"))
             .where("q = 1 and l_id is not null").select("l_id"))
    trust = saved(trust, "trusted")
    src = docs.select(col(id_col).alias("id"), text_hash(text_col).alias("text_hash"),
                      F.xxhash64(F.coalesce(col(lang_col).cast("string"), F.lit("\u0000"))).alias("lang"),
                      col(text_col).cast("string").alias("text"))
    held_out = F.pmod(F.xxhash64("id"), F.lit(10)) == 0
    marked = src.join(bounded_broadcast(trust, LABEL_BROADCAST_ROWS), F.col("id") == F.col("l_id"), "left")
    train = F.col("l_id").isNotNull() & ~held_out
    good = marked.where(F.col("l_id").isNotNull() & (F.length("text") > 0)).select("id", "text_hash", "lang")
    folds = saved(fold(good, held_out), "trusted-folds")
    counted, scored = marked.select("lang", train.alias("train"), "text"), src
    if folds.head(1):  # each fold counts as a language of its own
        few = bounded_broadcast(folds, LABEL_BROADCAST_ROWS)
        more = saved(src.join(few, ["id", "text_hash", "lang"]).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.lit(FOLDS - 1)))), "trusted-fold-texts")
        counted = counted.unionByName(more.select(
            fold_lang("other").alias("lang"), (F.col("other") != F.col("fold")).alias("train"), "text"))
        scored = scored.unionByName(more.where("other = fold").select("id", "text_hash", fold_lang("fold").alias("lang"), "text"))
    types = saved(count_grams(counted, order), "kn-types")
    bits = probabilities(types, order)
    n_shards = max(1, -(-types.count() // shard_rows))
    bits = saved(bits.withColumn("shard", F.pmod(F.xxhash64("lang", "code"), F.lit(n_shards))), "kn-bits")
    parts = []
    for k in range(n_shards):
        t = bits.where(F.col("shard") == k).select("lang", "code", F.col("bits").cast("float")).toArrow()
        lang, code = t.column(0).to_numpy(), t.column(1).to_numpy().view(np.uint64)
        cost, table = t.column(2).to_numpy(), {}
        for x in np.unique(lang):
            at = np.flatnonzero(lang == x)
            at = at[np.argsort(code[at])]
            table[int(x)] = (code[at], cost[at])
        parts.append(partial_scores(scored, spark.sparkContext.broadcast(table), order))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    total = saved(every.groupBy("id", "text_hash", "lang").agg(F.sum("bits").alias("bits"), F.sum("n").alias("n")),
                  "kn-scores")
    discard(types, bits)
    trusted = F.col("l_id").isNotNull()
    apart = bounded_broadcast(folds.select("id", "text_hash", "lang", fold_lang("fold").alias("f_lang")), LABEL_BROADCAST_ROWS)
    own = (total.withColumnRenamed("lang", "f_lang").join(apart, ["id", "text_hash", "f_lang"])
           .select("id", "text_hash", "lang", F.col("bits").alias("o_bits"), F.col("n").alias("o_n")))
    total = total.join(apart.select("id", "text_hash", F.col("f_lang").alias("lang")), ["id", "text_hash", "lang"], "left_anti")
    out = (total.join(trust, F.col("id") == F.col("l_id"), "left")
           .join(bounded_broadcast(saved(own, "kn-fold-scores"), LABEL_BROADCAST_ROWS), ["id", "text_hash", "lang"], "left"))
    held = lambda own, c: F.coalesce(F.col(own), F.when(trusted & held_out, F.col(c)))
    return out.select(
        "id", "text_hash", "lang", "bits", "n", trusted.alias("trusted"), (trusted & held_out).alias("held_out"),
        held("o_bits", "bits").alias("held_bits"), held("o_n", "n").alias("held_n"))


def decide(found: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, prior: int = PRIOR) -> DataFrame:
    """Per (id, text_hash): perplexity (per byte), score, threshold, rejected."""
    base = found.where("held_n > 0").select("lang", F.col("held_bits").alias("bits"), F.col("held_n").alias("n"))
    mean = _per_language(base.groupBy("lang").agg((F.sum("bits") / F.sum("n")).alias("mean")))
    score = (F.col("bits") + prior * F.col("mean")) / (F.col("n") + prior)
    limit = _per_language(base.join(mean, "lang").groupBy("lang").agg(
        (F.percentile_approx(score, F.lit(quantile), F.lit(100_000)) + margin).alias("threshold")))
    out = found.join(mean, "lang", "left").join(limit, "lang", "left").withColumn("score", score)
    return out.select(
        "id", "text_hash", F.when(F.col("n") > 0, F.pow(F.lit(2.0), F.col("bits") / F.col("n"))).alias("perplexity"),
        "score", "threshold", "trusted", "held_out",
        ((F.col("n") == 0) | F.coalesce(F.col("score") > F.col("threshold"), F.lit(False))).alias("rejected"))


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
            **names) -> DataFrame:
    """Per distinct (id, text_hash): perplexity, score, threshold, rejected."""
    return decide(scores(docs, labels, **names), quantile, margin)


def filter_documents(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang",
                     **names) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    kept = quality(docs, labels, id_col=id_col, text_col=text_col, lang_col=lang_col, **names).where("not rejected")
    keys = kept.select(F.col("id").alias("k_id"), F.col("text_hash").alias("k_hash"))
    return keep_rows(docs, keys, id_col, text_col, once=False)

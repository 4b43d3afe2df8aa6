"""Operator 12: quality rules, and perplexity bands of a modified Kneser-Ney model counted by Spark.

1. *Blocks.*  Each task takes its rows' features (words, symbols, repeated lines and
   three-word windows) and packs the texts that pass the base rules, by language, into
   blocks of about ``block_bytes``; a block is one row of a table bucketed by block, so
   that texts are never shuffled.
2. *Counts.*  Every block's n-grams (``order`` UTF-8 bytes, as 64-bit keys) are counted, and
   Spark adds them up: continuation counts, discounts, context weights and the interpolated
   probabilities are joins and aggregates between the count tables, for the whole corpus.
   Plain documents train the model: those with at most ``PLAIN_SYMBOLS`` percent symbols and
   ``PLAIN_REPEAT`` percent words in repeated windows.  Probabilities are made for every n-gram
   that occurs in any judged document, so none is unseen.
3. *Arrays.*  Each block is handed the model for just the n-grams that occur in it, as one
   array sorted by key, by a join on the n-gram; a block finds its costs by binary search.
   So no task or driver holds the model, however large it grows.
4. *Bands.*  A document's score is its bits per byte.  In each language the quartiles of
   the scores give a lower and an upper bound, ``width`` interquartile ranges (or ``least_width``
   bits, if that is more) away from them.  Documents outside the band are rejected: above are jumble and
   other languages, below is text that repeats what the corpus is full of.

Only documents that pass the base rules are judged by perplexity; in a language without plain
documents every byte costs 8 bits and nothing more is rejected.

Defined results: one result row per row, also for repeated rows and ids; null and empty texts have
no words, fail the base rules and have no perplexity; null language is a language of its own; an
empty table gives an empty result; other columns are not read.  A text longer than a block
is a block of its own.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.session import scratch_path

from .common import bounded_broadcast, col, discard, saved
from .quality import discounts, grams

ORDER = 5
WIDTH = 3.0
LEAST_WIDTH = 0.25
MIN_WORDS = 50
REPEAT_PERCENT = 50
PLAIN_SYMBOLS = 1            # percent of the characters in words
PLAIN_REPEAT = 10
BLOCK_BYTES = 16_000_000
CHUNK_BYTES = 1_000_000      # of text whose windows are compared at once
LANGUAGE_BROADCAST_ROWS = 100_000
FLUSH = 2_000_000            # model rows a task holds before it hands them on
LEVEL = 5                    # of compression
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def windows_repeated(words: list[list[bytes]]) -> np.ndarray:
    """Of each text, its words that lie in a window of three words found twice or more in it."""
    number: dict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    size = np.fromiter(map(len, words), np.int64, len(words))
    ids = np.fromiter((number[w] for ws in words for w in ws), np.int64, size.sum())
    doc = np.repeat(np.arange(len(words)), size)
    out = np.zeros(len(words), np.int64)
    at = np.flatnonzero(doc[:-2] == doc[2:]) if len(ids) > 2 else np.zeros(0, np.int64)
    if not len(at):
        return out
    code, most = doc[at], len(words)
    for j in range(3):
        if most * len(number) >= 1 << 62:  # as many numbers as there are different beginnings
            different, code = np.unique(code, return_inverse=True)
            most = len(different)
        code = code * len(number) + ids[at + j]
        most *= len(number)
    order = np.argsort(code, kind="stable")
    first = np.r_[True, code[order][1:] != code[order][:-1]]
    group = np.cumsum(first) - 1
    again = at[order[np.bincount(group)[group] > 1]]
    covered = np.zeros(len(ids), bool)
    for j in range(3):
        covered[again + j] = True
    return np.bincount(doc[covered], minlength=len(words))


def features(texts: list[str], raw: list[bytes]) -> np.ndarray:
    """FEATURES of texts, one column each."""
    out = np.zeros((len(texts), 5), np.int64)
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and size < CHUNK_BYTES:
            size += len(raw[end])
            end += 1
        words = [t.split() for t in raw[start:end]]  # bytes are split at ASCII white space
        out[start:end, 0] = [len(w) for w in words]
        out[start:end, 4] = windows_repeated(words)
        start = end
    for i, t in enumerate(texts):
        out[i, 1] = len(t) - sum(map(t.count, SPACES))
        out[i, 2] = sum(map(t.count, SYMBOLS))
        if "\n" in t:
            lines = [line for line in t.split("\n") if line.strip(SPACES)]
            out[i, 3] = len(lines) - len(set(lines))
    return out


def failed(f: np.ndarray) -> np.ndarray:
    return (f[:, 0] < MIN_WORDS) | (100 * f[:, 4] > REPEAT_PERCENT * f[:, 0])


def plain(f: np.ndarray) -> np.ndarray:
    return (100 * f[:, 2] <= PLAIN_SYMBOLS * f[:, 1]) & (100 * f[:, 4] <= PLAIN_REPEAT * f[:, 0])


def compressed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def pack_blocks(src: DataFrame, block_bytes: int) -> DataFrame:
    """Rows (id, lang, text) as blocks of one language: ids, features, sizes of texts, and the texts in one."""
    id_type = src.schema["id"].simpleString().split(":", 1)[1]
    schema = (f"block long, lang long, ids array<{id_type}>, "
              + ", ".join(f"{f} array<long>" for f in FEATURES) + ", plain array<boolean>, sizes array<long>, size long, texts binary")

    def run(batches):
        held: dict[int, list] = {}
        size: dict[int, int] = defaultdict(int)
        made = 0

        def hand_on(lang):
            nonlocal made
            rows = held.pop(lang)
            size.pop(lang)
            ids, found, train, texts = zip(*rows)
            whole = b"".join(texts)
            block = (TaskContext.get().partitionId() << 32) + made
            made += 1
            columns = np.array(found).T
            packed = compressed(whole) if whole else b""
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([lang]), pa.array([ids], pa.list_(id_of)),
                 *[pa.array([c.tolist()], pa.list_(pa.int64())) for c in columns], pa.array([train], pa.list_(pa.bool_())),
                 pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([len(whole)]),
                 pa.array([packed], pa.binary())],
                ["block", "lang", "ids", *FEATURES, "plain", "sizes", "size", "texts"])

        for b in batches:
            id_of = b.column(0).type
            texts = [t or "" for t in b.column(2).to_pylist()]
            raw = [t.encode("utf-8", "surrogatepass") for t in texts]
            found = features(texts, raw)
            out, train = failed(found), plain(found).tolist()
            for i, (key, lang) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                t = b"" if out[i] else raw[i]
                held.setdefault(lang, []).append((key, found[i], train[i], t))
                size[lang] += len(t) + 64  # what the features take
                if size[lang] >= block_bytes:
                    yield hand_on(lang)
        for lang in list(held):
            yield hand_on(lang)

    return src.mapInArrow(run, schema)


def texts_of(row) -> list[bytes]:
    """The texts of a block's row (size, sizes, texts)."""
    if not row["size"]:
        return [b""] * len(row["sizes"])
    whole = pa.decompress(row["texts"], row["size"], codec="zstd", asbytes=True)
    ends = np.cumsum(row["sizes"]).tolist()
    return [whole[e - n:e] for e, n in zip(ends, row["sizes"])]


def count_blocks(blocks: DataFrame, order: int) -> DataFrame:
    """(block, lang, code, n): the n-grams of every block, and how often they occur in its training texts."""
    names = ["block", "lang", "plain", "sizes", "size", "texts"]

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {k: b.column(j)[i].as_py() for j, k in enumerate(names)}
                texts, parts = texts_of(row), []
                for train in (True, False):
                    for code, _ in grams([t for t, p in zip(texts, row["plain"]) if t and p == train], order):
                        code, n = np.unique(code, return_counts=True)
                        parts.append((code, n * train))
                if not parts:
                    continue
                code, n = (np.concatenate(p) for p in zip(*parts))
                by = np.argsort(code, kind="stable")
                code = code[by]
                first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
                code, n = code[first].view(np.int64), np.add.reduceat(n[by], first)
                for at in range(0, len(code), 1 << 16):
                    c = code[at:at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(c), row["block"])), pa.array(np.full(len(c), row["lang"])), pa.array(c),
                         pa.array(n[at:at + (1 << 16)])], ["block", "lang", "code", "n"])

    return blocks.select(names).mapInArrow(run, "block long, lang long, code long, n long")


def sorted_arrays(costs: DataFrame) -> DataFrame:
    """(block, part): pieces of each block's model from rows (block, code, bits), sorted by code and packed."""

    def run(batches):
        held: dict[int, list] = defaultdict(list)
        size = 0

        def hand_on():
            for block in sorted(held):
                code, bits = (np.concatenate(c) for c in zip(*held.pop(block)))
                by = np.argsort(code)
                # steps between sorted keys are small numbers; equal bytes of the costs stand together
                steps = np.diff(code[by], prepend=code.dtype.type(0)).view(np.uint8).reshape(-1, 8).T
                whole = steps.tobytes() + bits[by].view(np.uint8).reshape(-1, 4).T.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([len(by).to_bytes(8, "little") + compressed(whole)],
                                                 pa.binary())], ["block", "part"])

        for b in batches:
            blocks = b.column(0).to_numpy()
            by = np.argsort(blocks, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(blocks[by]) != 0, True][:len(by) + 1]) if len(by) else []
            code, bits = b.column(1).to_numpy(), b.column(2).to_numpy()
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                held[int(blocks[by[lo]])].append((code[by[lo:hi]], bits[by[lo:hi]]))
            size += len(by)
            if size > FLUSH:
                yield from hand_on()
                size = 0
        yield from hand_on()

    return costs.select("block", "code", "bits").mapInArrow(run, "block long, part binary")


def model_of(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their costs."""
    codes, costs = [], []
    for part in parts:
        n = int.from_bytes(part[:8], "little")
        whole = np.frombuffer(pa.decompress(part[8:], 12 * n, codec="zstd"), np.uint8)
        codes.append(np.cumsum(np.ascontiguousarray(whole[:8 * n].reshape(8, n).T).view(np.int64).ravel()))
        costs.append(np.ascontiguousarray(whole[8 * n:].reshape(4, n).T).view(np.float32).ravel())
    code, cost = np.concatenate(codes).view(np.uint64), np.concatenate(costs)
    by = np.argsort(code)
    return code[by], cost[by]


def kneser_ney(types: DataFrame, order: int) -> DataFrame:
    """(lang, code, bits) of every n-gram (lang, code, c; c: how often in training texts): interpolated modified Kneser-Ney."""

    def end(n):
        return F.col("code").bitwiseAND(F.lit((1 << 8 * n) - 1))

    level = {order: types.where("c > 0")}
    for n in range(order - 1, 0, -1):  # of shorter n-grams, the different bytes before them are counted
        level[n] = saved(level[n + 1].groupBy("lang", end(n).alias("code")).agg(F.count(F.lit(1)).alias("c")), "rules-counts")
    lower = None
    for n in range(1, order + 1):
        d = bounded_broadcast(saved(discounts(level[n]), "rules-discounts"), LANGUAGE_BROADCAST_ROWS)
        context = F.shiftrightunsigned("code", 8).alias("context")
        cut = level[n].join(d, "lang").select(
            "lang", "code", context, "c",
            F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3")).alias("d"))
        free = cut.groupBy("lang", "context").agg(F.sum("c").alias("total"), F.sum("d").alias("free"))
        asked = types.select("lang", "code") if n == order else types.select("lang", end(n).alias("code")).distinct()
        p = asked.withColumn("context", context).join(free, ["lang", "context"], "left")
        p = p.join(cut.select("lang", "code", (F.col("c") - F.col("d")).alias("own")), ["lang", "code"], "left")
        if lower is None:
            p = p.withColumn("q", F.lit(1 / 256))
        else:
            p = p.withColumn("end", end(n - 1))
            p = p.join(lower.select("lang", F.col("code").alias("end"), F.col("p").alias("q")), ["lang", "end"])
        seen = (F.coalesce("own", F.lit(0.0)) + F.col("free") * F.col("q")) / F.col("total")
        p = p.select("lang", "code", F.coalesce(seen, F.col("q")).alias("p"))  # a context never seen leaves it to the shorter one
        before, lower = lower, saved(p, "rules-model")
        discard(*([before] if before is not None else []))
    discard(*(level[n] for n in range(1, order)))
    return lower.select("lang", "code", (-F.log2("p")).cast("float").alias("bits"))


def score_blocks(blocks: DataFrame, order: int) -> DataFrame:
    """Per row of each block: id, lang, features, bits and bytes; ``model``: the pieces of ``sorted_arrays``."""
    id_type = blocks.schema["ids"].simpleString().split("array<", 1)[1][:-1]
    names = ["lang", "sizes", "size", "texts"]
    schema = f"id {id_type}, lang long, " + ", ".join(f"{f} long" for f in FEATURES) + ", bits double, bytes long"

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {k: b.column(k)[i].as_py() for k in names}
                n = len(row["sizes"])
                bits = np.zeros(n)
                if row["size"]:
                    key, cost = model_of(b.column("model")[i].as_py())
                    for code, doc in grams(texts_of(row), order):
                        bits += np.bincount(doc, cost[np.searchsorted(key, code)], n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("ids")[i].values, pa.array(np.full(n, row["lang"])),
                     *[b.column(f)[i].values for f in FEATURES], pa.array(bits), pa.array(row["sizes"], pa.int64())],
                    ["id", "lang", *FEATURES, "bits", "bytes"])

    return blocks.select("ids", *FEATURES, *names, "model").mapInArrow(run, schema)


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", order: int = ORDER,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: id, lang (hash), features, bits and bytes (0 where the base rules fail)."""
    if not 2 <= order <= 7:
        raise ValueError("order must be from 2 to 7")
    spark = docs.sparkSession
    src = docs.select(col(id_col).alias("id"),
                      F.xxhash64(F.coalesce(col(lang_col).cast("string"), F.lit("\u0000"))).alias("lang"),
                      col(text_col).cast("string").alias("text"))
    name = f"rules_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pack_blocks(src, block_bytes).write.bucketBy(buckets, "block").option(
        "path", scratch_path(spark, "rules-blocks")).saveAsTable(name)
    blocks = spark.table(name)
    asked = saved(count_blocks(blocks, order), "rules-asked")
    counts = saved(asked.groupBy("lang", "code").agg(F.sum("n").alias("c")), "rules-counts")
    model = kneser_ney(counts, order)
    arrays = sorted_arrays(asked.select("block", "lang", "code").join(model, ["lang", "code"])).groupBy("block").agg(
        F.collect_list("part").alias("model"))  # one piece per task; all of them hold each n-gram of the block once
    return saved(score_blocks(blocks.join(arrays, "block", "left"), order), "rules-scores")


def decide(found: DataFrame, width: float = WIDTH, least_width: float = LEAST_WIDTH) -> DataFrame:
    """id, features, base_failed, score (bits per byte), perplexity (per byte), lower, upper, kept."""
    score = F.when(F.col("bytes") > 0, F.col("bits") / F.col("bytes"))
    found = found.withColumn("score", score).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    q = F.percentile_approx("score", F.array(F.lit(0.25), F.lit(0.75)), F.lit(10_000)).alias("q")
    margin = F.greatest(F.lit(width) * (F.col("q")[1] - F.col("q")[0]), F.lit(least_width))
    bands = found.where("score is not null").groupBy("lang").agg(q).select(
        "lang", (F.col("q")[0] - margin).alias("lower"), (F.col("q")[1] + margin).alias("upper"))
    bands = bounded_broadcast(saved(bands, "rules-bands"), LANGUAGE_BROADCAST_ROWS)
    out = found.join(bands, "lang", "left")
    kept = ~F.col("base_failed") & F.coalesce(F.col("score").between(F.col("lower"), F.col("upper")), F.lit(False))
    return out.select("id", *FEATURES, "base_failed", kept.alias("kept"), "score",
                      F.pow(F.lit(2.0), "score").alias("perplexity"), "lower", "upper")


def quality_rules(docs: DataFrame, width: float = WIDTH, least_width: float = LEAST_WIDTH, **names) -> DataFrame:
    """One row per row of ``docs``: features, base_failed, perplexity with its band, kept."""
    return decide(scores(docs, **names), width, least_width)

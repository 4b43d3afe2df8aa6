"""Operator 11: phrase collocations by SON partitioning.

Everything is per language.  Texts are cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words at spaces and tabs, A-Z in lower case; a phrase is a run of words
within a piece.  Phrases of 2 to ``max_words`` words that occur ``support`` times are
candidates, and are scored by their worst cut into two parts.

1. Each task writes its rows as shards of at most about ``shard_words`` words, numbered by a
   dictionary of the shard.  Words are counted; those with ``support`` occurrences are the phrases
   of length 1, and the shards are written again with these words only.
2. For every length k from 2 on:

   a. *Mine.*  Each shard is mined completely at its share of the support: a phrase with
      ``support`` occurrences in n words has ``support * n_s / n`` or more in some shard
      of n_s words.  Only phrases whose two parts of k - 1 words are frequent in the
      whole corpus are looked at.
   b. *Unite.*  Locally frequent phrases are united as a bit table of a fixed size
      (``bits`` bits by phrase hash), with one bound: a phrase has less than the local support
      in every shard that does not report it, so its local counts must make up for what these
      leave open.  Nothing is lost; what shares a slot with others is counted with them.
   c. *Count.*  All occurrences of the phrases in the table are counted over all shards,
      by their words, exactly; those with ``support`` occurrences are the candidates.

The bit tables are all that goes through the driver, and their size does not grow with
the corpus.  With more shards the local support falls to 1, and the bound becomes the support
itself; as slots fill up, more phrases are counted, and the results stay the same.  Cuts and enclosing phrases are found by joins between
the counted phrases.

Defined results: null text counts as empty, null language as ``und``; rows are not told
apart by their id, so repeated rows count as often as they occur; a language without
candidates gives no rows, and an empty table an empty result; other columns are not read.
One text is held whole by its task.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, col, discard, saved

SUPPORT = 100
MAX_WORDS = 5
TOP = 2000
COVER_PERCENT = 100
SHARD_WORDS = 4_000_000
CHUNK_BYTES = 2_000_000     # split into words at once
BITS = 27                   # logarithm of a bit table's size
LANGUAGE_BROADCAST_ROWS = 100_000

SCORE = ("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(18, 0)))"  # exact beyond 64 bits
         " div (cast(l as decimal(19, 0)) * cast(r as decimal(18, 0)))")
STOP = b"."                 # stands for every piece border; in no word
BORDERS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(46 if c in BORDERS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(texts: list[bytes]) -> list[bytes]:
    """Words of texts, with ``STOP`` where pieces end."""
    return b".".join([*texts, b""]).translate(TABLE).replace(STOP, b" . ").split()


class Shard:
    """The words of some rows as numbers, by language; 0 is a piece border."""

    def __init__(self):
        self.number: dict[str, dict[bytes, int]] = {}
        self.parts: dict[str, list[np.ndarray]] = {}
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        if lang not in self.number:
            number = self.number[lang] = defaultdict()
            number.default_factory = number.__len__
            number[STOP]
            self.parts[lang] = []
        words = words_of(texts)
        self.parts[lang].append(np.fromiter(map(self.number[lang].__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def rows(self):
        """One row a language."""
        for lang in list(self.parts):
            ids = np.concatenate(self.parts.pop(lang))
            if len(ids):
                yield encoded(lang, int(np.count_nonzero(ids)), ids, list(self.number.pop(lang)))


SHARDS = "lang string, n_words long, size long, ids binary, letters long, dictionary binary"


def encoded(lang: str, n_words: int, ids: np.ndarray, words: list[bytes]) -> pa.RecordBatch:
    """One language of a shard as a row: the words' numbers, and the words by number (none holds a space)."""
    letters = b" ".join(words)
    row = {"lang": lang, "n_words": n_words, "size": len(ids), "ids": pa.compress(ids.tobytes(), codec="zstd", asbytes=True),
           "letters": len(letters), "dictionary": pa.compress(letters, codec="zstd", asbytes=True)}
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))


def decoded(batches):
    """(language, its hash, words, numbers, words by number, further columns) of every row of ``encoded``."""
    for b in batches:
        for i in range(b.num_rows):
            lang, n_words, size, ids, letters, dictionary, *rest = (c[i].as_py() for c in b.columns)
            ids = np.frombuffer(pa.decompress(ids, 4 * size, codec="zstd"), np.int32)
            words = pa.decompress(dictionary, letters, codec="zstd", asbytes=True).split(b" ")
            yield lang, np.uint64(xxhash.xxh64_intdigest(lang.encode())), n_words, ids, words, rest


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """Rows (lang, text) as shards (``SHARDS``): the words of a task's rows, at most about ``limit`` at once."""

    def run(batches):
        shard, waiting, size = Shard(), {}, defaultdict(int)
        for b in batches:
            text = b.column(1)
            text = text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary())
            for lang, t in zip(b.column(0).to_pylist(), text):
                t = t.as_py() or b""
                waiting.setdefault(lang, []).append(t)
                size[lang] += len(t)
                if size[lang] >= CHUNK_BYTES:
                    shard.add(lang, waiting.pop(lang))
                    del size[lang]
                    if shard.size >= limit:
                        yield from shard.rows()
                        shard = Shard()
        for lang, texts in waiting.items():
            shard.add(lang, texts)
        yield from shard.rows()

    return docs.mapInArrow(run, SHARDS)


def narrowed(rows: DataFrame, words, bits: int) -> DataFrame:
    """Shards whose words are those in the bit table only; others become piece borders, of several in a row one stays."""

    def run(batches):
        for lang, key, n_words, ids, known, _ in decoded(batches):
            good = has(words.value, slot(hashes_of(known), key, bits))
            good[0] = False
            number = np.where(good, np.cumsum(good), 0).astype(np.int32)
            ids = number[ids]
            ids = ids[(ids > 0) | np.r_[True, ids[:-1] > 0]]
            yield encoded(lang, n_words, ids, [STOP, *(w for w, g in zip(known, good) if g)])

    return rows.mapInArrow(run, SHARDS)


def slot(h: np.ndarray, lang: np.uint64, bits: int) -> np.ndarray:
    return ((h ^ lang) * MIX) >> np.uint64(64 - bits)


def phrase_hash(hashes: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    h = hashes[ids[at]]
    for j in range(1, k):
        h = h * STEP + hashes[ids[at + j]]
    return h


def has(table: np.ndarray, s: np.ndarray) -> np.ndarray:
    return (table[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) == 1


def exact_groups(ids: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the equal phrases at these places: one place and the number of each."""
    if not len(at):
        return at, at
    code, width = ids[at].astype(np.int64), int(ids.max()) + 1
    most = width
    for j in range(1, k):
        if most * width >= 1 << 62:  # as many numbers as there are different beginnings
            different, code = np.unique(code, return_inverse=True)
            most = len(different)
        code = code * width + ids[at + j]
        most *= width
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    return at[order[first]], np.diff(np.r_[first, len(code)])


def _runs(good: np.ndarray, k: int) -> np.ndarray:
    """Places where k good words begin."""
    v = good
    for j in range(1, k):
        v = v[:-1] & good[j:]
    return np.flatnonzero(v)


def words_counted(rows: DataFrame) -> DataFrame:
    """(lang, phrase, f) of all words of shards."""

    def run(batches):
        for lang, _, _, ids, words, _ in decoded(batches):
            n = np.bincount(ids, minlength=len(words))
            for i in range(1, len(words), 1 << 16):
                some = pa.array(words[i:i + (1 << 16)], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), some, pa.array(n[i:i + (1 << 16)])],
                                                 ["lang", "phrase", "f"])

    return rows.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def mine(rows: DataFrame, k: int, parts, support: int, bits: int) -> DataFrame:
    """Slots of the phrases of k words that are frequent in a shard; ``rows`` has ``total`` and ``excess`` too."""

    def run(batches):
        found = Slots()
        for _, key, n_words, ids, words, (total, excess) in decoded(batches):
            hashes, good = hashes_of(words), ids > 0
            at = _runs(good, k)
            if k > 2 and len(at):
                ends = _runs(good, k - 1)
                frequent = np.zeros(len(ids), bool)
                frequent[ends] = has(parts.value, slot(phrase_hash(hashes, ids, ends, k - 1), key, bits))
                at = at[frequent[at] & frequent[at + 1]]
            h = np.sort(phrase_hash(hashes, ids, at, k))
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][:len(h)])
            n = np.diff(np.r_[first, len(h)])
            least = -(-support * n_words // total)
            often = n >= least
            found.add(slot(h[first[often]], key, bits), -(-NEED * np.minimum(n[often] - least + 1, excess) // excess))
            if found.size > HOLD:
                yield from found.segments()
        yield from found.segments()

    return rows.mapInArrow(run, SEGMENTS)


def count(rows: DataFrame, k: int, found, bits: int) -> DataFrame:
    """(lang, phrase, f): occurrences of the phrases of k words in the bit table."""

    def run(batches):
        for lang, key, _, ids, words, _ in decoded(batches):
            at = _runs(ids > 0, k)
            at = at[has(found.value, slot(phrase_hash(hashes_of(words), ids, at, k), key, bits))]
            at, n = exact_groups(ids, at, k)
            for i in range(0, len(at), 1 << 14):
                rows_ = ids[at[i:i + (1 << 14), None] + np.arange(k)].tolist()
                some = [b" ".join([words[j] for j in row]) for row in rows_]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array(some, pa.binary()).cast(pa.string()),
                     pa.array(n[i:i + (1 << 14)])], ["lang", "phrase", "f"])

    return rows.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


SEGMENTS = "segment int, slots binary"  # 16-bit places in the segment, then as many 16-bit parts of NEED
BITMAPS = "segment int, bits binary"
SEGMENT = 15                            # logarithm of a segment's slots
NEED = 50_000                           # a slot is set if its parts reach this; 16 bits hold it
HOLD = 8_000_000                        # slots a task holds before it hands them on


class Slots:
    """Parts of ``NEED`` by slot, added up and cut into segments."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, s: np.ndarray, parts: np.ndarray) -> None:
        self.held.append((s, np.minimum(parts, NEED).astype(np.uint32)))
        self.size += len(s)

    def segments(self):
        if not self.size:
            return
        s, parts = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        by = np.argsort(s, kind="stable")
        s = s[by]
        first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        parts = np.minimum(np.add.reduceat(parts[by].astype(np.int64), first), NEED).astype("<u2")
        s = s[first]
        segment = (s >> np.uint64(SEGMENT)).astype(np.int64)
        place = (s & np.uint64((1 << SEGMENT) - 1)).astype("<u2")
        cuts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1], True])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array([segment[lo]], pa.int32()),
                 pa.array([place[lo:hi].tobytes() + parts[lo:hi].tobytes()], pa.binary())], ["segment", "slots"])


def bit_table(pieces: DataFrame, bits: int):
    """One broadcast array of 2 ** bits bits: the slots whose parts reach ``NEED``."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for segment, slots in zip(b.column(0).to_pylist(), b.column(1)):
                both = np.frombuffer(slots.as_py(), "<u2").reshape(2, -1)
                total = held.setdefault(segment, np.zeros(1 << SEGMENT, np.uint32))
                total[both[0]] = np.minimum(total[both[0]] + both[1], NEED)
        for segment, total in held.items():
            bitmap = np.packbits(total >= NEED, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([bitmap], pa.binary())],
                                             ["segment", "bits"])

    table = np.zeros((max(1, 1 << max(bits - SEGMENT, 0)), (1 << SEGMENT) // 64), np.uint64)
    t = pieces.repartition("segment").mapInArrow(run, BITMAPS).toArrow()  # of a fixed size, whatever the corpus
    for segment, bitmap in zip(t.column(0).to_pylist(), t.column(1).to_pylist()):
        table[segment] = np.frombuffer(bitmap, np.uint64)
    return pieces.sparkSession.sparkContext.broadcast(table.ravel())


def table_of(phrases: DataFrame, bits: int):
    """The bit table of phrases (lang, phrase)."""

    def run(batches):
        found = Slots()
        for b in batches:
            langs = [xxhash.xxh64_intdigest(x.encode()) for x in b.column(0).to_pylist()]
            h = np.zeros(b.num_rows, np.uint64)
            for i, p in enumerate(b.column(1).to_pylist()):
                value = 0
                for word in p.encode().split(b" "):
                    value = (value * int(STEP) + xxhash.xxh64_intdigest(word)) & 0xFFFFFFFFFFFFFFFF
                h[i] = value
            found.add(slot(h, np.array(langs, np.uint64), bits), np.full(len(h), NEED))
            if found.size > HOLD:
                yield from found.segments()
        yield from found.segments()

    return bit_table(phrases.select("lang", "phrase").mapInArrow(run, SEGMENTS), bits)


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                     max_words: int = MAX_WORDS, shard_words: int = SHARD_WORDS,
                     bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of all phrases of 1 to ``max_words`` words with ``support`` occurrences, and (lang, n)."""
    lang = F.coalesce(col(lang_col).cast("string"), F.lit("und"))
    src = docs.select(lang.alias("lang"), col(text_col).cast("string").alias("text"))
    whole = saved(shards(src, shard_words), "phrase-shards")
    totals = saved(whole.groupBy("lang").agg(F.sum("n_words").alias("n")).where("n > 0"), "phrase-totals")
    words = saved(words_counted(whole).where(F.col("f") >= support), "phrase-level")
    given = table_of(words, bits)
    rows = saved(narrowed(whole, given, bits), "phrase-shards")
    given.unpersist()
    discard(whole)
    sizes = totals.withColumnRenamed("n", "total")
    # what a phrase may have without being frequent in any shard is the sum of (local support - 1); the rest is to be found
    below = F.expr(f"greatest(({support} * n_words + total - 1) div total - 1, 0)")
    excess = rows.select("lang", "n_words").join(bounded_broadcast(sizes, LANGUAGE_BROADCAST_ROWS), "lang").groupBy("lang").agg(
        F.first("total").alias("total"), (F.lit(support) - F.sum(below)).alias("excess"))
    excess = bounded_broadcast(saved(excess, "phrase-excess"), LANGUAGE_BROADCAST_ROWS)
    dealt = rows.join(excess, "lang").select(*rows.columns, "total", "excess")
    levels, parts = [words.withColumn("k", F.lit(1))], None
    for k in range(2, max_words + 1):
        local = bit_table(mine(dealt, k, parts, support, bits), bits)
        level = saved(count(rows, k, local, bits).where(F.col("f") >= support), "phrase-level")
        local.unpersist()
        levels.append(level.withColumn("k", F.lit(k)))
        if parts is not None:
            parts.unpersist()
        if k == max_words or not level.head(1):
            break
        parts = table_of(level, bits)
    discard(rows)
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.select("lang", "k", "phrase", "f"), totals


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
                 max_words: int = MAX_WORDS, top: int = TOP, cover_percent: int = COVER_PERCENT,
                 shard_words: int = SHARD_WORDS, bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best phrases of every language.

    Of a cut after the first words, l and r count the first part and the rest, and the score is
    floor(1000 a n / (l r)); the lowest-scoring cut counts, ties going to the shortest first part.
    A phrase within a longer candidate that has ``cover_percent`` of its occurrences or more is dropped.
    """
    found, totals = frequent_phrases(docs, text_col, lang_col, support, max_words, shard_words, bits)
    words = F.split("phrase", " ")
    cand = found.where("k >= 2").withColumn("words", words)

    def part(first, n):
        return F.array_join(F.slice("words", first, n), " ")

    cuts = cand.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut", part(F.lit(1), F.col("cut")).alias("left"),
        part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(found.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.join(bounded_broadcast(totals, LANGUAGE_BROADCAST_ROWS), "lang")
    best = cuts.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "cut", "l", "r")).alias("b"))

    inner = cand.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
    inner = inner.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    cover = inner.select("lang", part(F.col("first"), F.col("size")).alias("phrase"), F.col("f").alias("c"))
    cover = cover.groupBy("lang", "phrase").agg(F.max("c").alias("cover"))
    best = best.join(cover, ["lang", "phrase"], "left").where(
        F.col("cover").isNull() | (100 * F.col("cover") < cover_percent * F.col("a")))
    best = best.select("lang", "phrase", "a", "n", "b.score", "b.l", "b.r")
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations_sql(support: int = SUPPORT, max_words: int = MAX_WORDS, top: int = TOP,
                     cover_percent: int = COVER_PERCENT) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                                      '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM piece),
spot AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
every AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM spot, range(1, {max_words} + 1) AS t(k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM every GROUP BY ALL HAVING count(*) >= {support}),
n AS (SELECT lang, count(*) AS n FROM spot GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cut AS (SELECT lang, k, phrase, a, ws, unnest(range(1, k)) AS c FROM cand),
scored AS (
  SELECT cut.lang, cut.phrase, a, c, x.f AS l, y.f AS r, n.n,
         ((1000::HUGEINT * a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(ws[1:c], ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(ws[c + 1:], ' ')
           JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
longer AS (SELECT lang, a, ws, k, unnest(range(2, k)) AS m FROM cand WHERE k > 2),
inside AS (SELECT lang, a, ws, m, unnest(range(1, k - m + 2)) AS i FROM longer),
cover AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS cover FROM inside GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN cover USING (lang, phrase)
         WHERE cover IS NULL OR 100 * cover < {cover_percent} * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
WHERE rank <= {top}"""

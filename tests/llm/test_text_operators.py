from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.llm import pieces, quality, surrogates, tokenfile
from sparktab.llm.common import saved
from sparktab.session import scratch_path

from .conftest import invented

ODD = ["", "a", " ", "  a\n b\t▁é\u0000 c  d ", "▁▁ x", "日本語 🎉🎉", "x" * 3000, "    ", "\n\n", "tail ",
       "<s> </s> <unk> <0x41>", "x  y   z\u001c w", "'s 's's I'll we 'll", "<|endoftext|> a<|endoftext|>"]


# --- Kneser-Ney -----------------------------------------------------------------------------------------------------

def slow_model(train: list[str], order: int):
    """Interpolated modified Kneser-Ney by dictionaries."""
    counts = {order: Counter()}
    for t in train:
        b = b"\xff" * (order - 1) + t.encode()
        for i in range(len(t.encode())):
            counts[order][b[i:i + order]] += 1
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    cut = {}
    for n, c in counts.items():
        k = [0] + [sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + k[2] else 0
        cut[n] = [min(max(i - (i + 1) * y * k[i + 1] / k[i] if k[1] and k[i] else 0.5, 0.05), i - 0.05)
                  for i in (1, 2, 3)]
    total, weight = Counter(), Counter()
    for n, c in counts.items():
        for g, v in c.items():
            total[n, g[:-1]] += v
            weight[n, g[:-1]] += cut[n][min(v, 3) - 1]

    def p(g):
        n = len(g)
        if not n:
            return 1 / 256
        lower = p(g[1:])
        if not total[n, g[:-1]]:
            return lower
        v = counts[n][g]
        rest = max(v - cut[n][min(v, 3) - 1], 0) if v else 0
        return (rest + weight[n, g[:-1]] * lower) / total[n, g[:-1]]

    return p


def test_perplexity_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, invented(rng, 30), "en") for i in range(40)] + [(90, "@@ ## é", "en"), (91, "zz", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(30)], "doc_id long, quality int")
    found = quality.scores(docs, labels, order=3)
    some = {r.id: r for r in found.collect()}
    held = {i for i, r in some.items() if r.held_out}
    p = slow_model([t for i, t, _ in rows if i < 30 and i not in held], 3)
    for i, t, lang in rows:
        b = b"\xff\xff" + t.encode()
        want = sum(-math.log2(p(b[k:k + 3]) if lang == "en" else 1 / 256) for k in range(len(t.encode())))
        assert some[i].n == len(t.encode())
        assert some[i].bits == pytest.approx(want, rel=1e-5)
    shards = {r.id: r.bits for r in quality.scores(docs, labels, order=3, shard_rows=150).collect()}
    assert all(shards[i] == pytest.approx(some[i].bits) for i in shards)


def test_probabilities_sum_to_one():
    p = slow_model(["abracadabra", "banana"], 3)
    assert sum(p(b"an" + bytes([x])) for x in range(256)) == pytest.approx(1)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    texts = [b"abcabcabd" * 5, b"", b"x"]
    whole = [np.concatenate(c) for c in zip(*quality.grams(texts, 4))]
    monkeypatch.setattr(quality, "CHUNK", 7)
    parts = [np.concatenate(c) for c in zip(*quality.grams(texts, 4))]
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_quality_filter(spark, odd, labels, nothing, no_labels):
    kept = quality.filter_documents(odd, labels)
    assert kept.columns == odd.columns
    found = quality.quality(odd, labels)
    assert found.where("perplexity is null and not rejected").count() == 0
    assert found.where("trusted and held_out and rejected").count() == 0
    assert quality.quality(odd, no_labels).where("rejected and perplexity is not null").count() == 0
    assert quality.filter_documents(nothing, labels).count() == 0


def test_quality_separates_junk(spark):
    rng = random.Random(2)
    rows = [(i, invented(rng, 60), "en") for i in range(150)]
    rows += [(1000 + i, " ".join("".join(rng.choice("#%&QZXJ") for _ in range(5)) for _ in range(60)), "en")
             for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i in range(100)], "doc_id long, quality int")
    bad = {r.id for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels)
           .where("rejected").collect()}
    assert bad == set(range(1000, 1020))


def test_language_without_held_out_text_and_short_junk(spark):
    """A language whose few trusted texts are all trained on has a threshold too; junk of 16 bytes goes."""
    rng = random.Random(3)
    held = {r.id for r in spark.range(400).where("pmod(xxhash64(id), 10) = 0").collect()}
    few = [i for i in range(200, 400) if i not in held][:12]
    rows = [(i, invented(rng, 60), "en") for i in range(150)] + [(i, invented(rng, 60), "fr") for i in few]
    rows += [(1000 + i, "".join(rng.choice("#%&QZXJ") for _ in range(size)), lang)
             for i, (lang, size) in enumerate([("en", 16)] * 5 + [("fr", 400)] * 5)]
    labels = spark.createDataFrame([(i, 1) for i in [*range(100), *few]], "doc_id long, quality int")
    found = quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string"), labels)
    assert sorted(r.id for r in found.where("rejected").collect()) == list(range(1000, 1010))
    assert found.count() == len(rows)


# --- SentencePiece --------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.model_path())


def test_round_trip_and_independence_of_the_batch(model):
    keys = np.arange(len(ODD), dtype=np.uint64)
    together = pieces.encode_batch(model, ODD, keys)
    for t, k, ids in zip(ODD, keys, together):
        assert model.decode(ids).decode() == t
        assert pieces.encode_batch(model, [t], np.array([k]))[0].tolist() == ids.tolist()
        assert len(ids) == 0 or ids.min() > 2  # no control pieces


def test_samples_follow_the_lattice(model):
    """Frequencies of sampled segmentations against all segmentations of a word, by enumeration."""
    import sentencepiece

    loose = pieces.Pieces(pieces.model_path(), theta=0.5)
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    vocab = {sp.id_to_piece(i): i for i in range(3, sp.get_piece_size()) if not sp.is_byte(i)}
    word = "▁other"

    def paths(s):
        if not s:
            return [()]
        return [(vocab[s[:n]], *rest) for n in range(1, len(s) + 1) if s[:n] in vocab for rest in paths(s[n:])]

    weight = {p: math.exp(sum(loose.logp[i] for i in p)) for p in paths(word)}
    n = 20_000
    got = Counter(tuple(x.tolist()) for x in pieces.encode_batch(loose, ["other"] * n, np.arange(n, dtype=np.uint64)))
    total = sum(weight.values())
    assert set(got) <= set(weight)
    for p, w in weight.items():
        assert abs(got[p] / n - w / total) < 5 * math.sqrt(w / total / n) + 1e-3


def test_pieces_on_spark(odd, odd_rows, nothing):
    out = pieces.decode(pieces.encode(odd)).collect()
    assert len(out) == len(odd_rows) and all(r.lossless for r in out)
    again = pieces.encode(odd.repartition(7)).collect()
    assert sorted((str(r.id), tuple(r.ids)) for r in again) == sorted((str(r.id), tuple(r.ids)) for r in out)
    assert pieces.decode(pieces.encode(nothing)).count() == 0


# --- token files ----------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenfile.tokenizer_path())
    return t


def test_encoder_equals_the_library(tokenizer):
    e = tokenfile.Encoder(tokenfile.tokenizer_path())
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice(" \n\tab.'é1 ") for _ in range(60)) for _ in range(300)]
    ids, counts = e.encode(texts)
    for t, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_pack_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        x = (rng.integers(0, 2 ** 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = tokenfile.pack(x)
        assert (tokenfile.unpack(control, data, n) == x).all()
        assert len(control) == -(-n // 4)


def test_token_files(spark, odd, odd_rows, tokenizer):
    folder = scratch_path(spark, "tok-test")
    tokenfile.write_tokens(odd, folder, block_tokens=5000)
    got = tokenfile.read_tokens(spark, folder).orderBy("start").collect()
    assert len(got) == len(odd_rows)
    start = 0
    for r in got:
        assert r.start == start
        start += len(r.ids)
    ids = [r.id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    want = sorted((str(i), tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in odd_rows)
    assert sorted((str(r.id), tuple(r.ids)) for r in got) == want
    crc = {(r.id, r.start): r.ids_crc32 for r in tokenfile.digests(spark, folder).collect()}
    assert all(crc[r.id, r.start] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)


def test_token_files_of_nothing(spark, nothing):
    folder = scratch_path(spark, "tok-none")
    tokenfile.write_tokens(nothing, folder)
    assert tokenfile.digests(spark, folder).count() == 0


# --- surrogates -----------------------------------------------------------------------------------------------------

TEXT = ('Contact Mr. John Smith or Mrs. Anna Smith (JOHN.DOE@Mail.Example.com, john.doe@mail.example.com), '
        '+1 (017) 555-7713, IP 97.51.17.173, card 4111 1111 1111 1111, SSN 123-45-6789, '
        'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B", DE89 3704 0044 0532 0130 00. Smith said: Version 2.0, 1.2.3.4.5')


def test_surrogates_keep_type_and_format():
    new, kinds = surrogates.replace(TEXT, b"k", {})
    assert Counter(kinds) == {"name": 5, "email": 2, "phone": 1, "ip": 1, "card": 1, "ssn": 1, "secret": 1, "iban": 1}
    assert [k.split(":")[0] for *_, k, _ in surrogates.find(new)] == kinds
    for s in ("John", "Smith", "Anna", "97.51", "4111", "555-7713", "9233A8", "3704", "123-45", "JOHN", "john"):
        assert s not in new
    assert "Version 2.0, 1.2.3.4.5" in new
    by = {}
    for s, e, k, c in surrogates.find(new):
        by.setdefault(k.split(":")[0], []).append(new[s:e])
    assert by["email"][0].lower() == by["email"][1].lower()
    assert surrogates.luhn_rest(by["card"][0].replace(" ", "")) == 0
    assert surrogates.iban_rest(by["iban"][0].replace(" ", "")) == 1
    assert by["phone"][0].startswith("+1 (") and len(by["phone"][0]) == len("+1 (017) 555-7713")
    assert surrogates.replace(TEXT, b"k", {})[0] == new != surrogates.replace(TEXT, b"other", {})[0]


def test_names_agree_in_gender_script_and_mention():
    new, _ = surrogates.replace("Frau Anna Weber und г-н Иван Петров. Weber und Петров", b"k", {})
    _, given, sur, _, _, ru, ru_sur, _, _, _ = [x.strip(".") for x in new.replace("г-н", "г").split()][:10]
    assert new.count(sur) == 2 and new.count(ru_sur) == 2
    assert given[-1] in "aie" and surrogates.script_of(ru) == "cyrillic" and ru[-1] in "нрв"


def test_collisions_are_resolved(spark):
    """All two-letter locals at one domain: far more collisions than attempts leave at first."""
    names = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"][:400]
    e = saved(spark.createDataFrame([("email", f"{x}@q.com") for x in names], "kind string, entity string"), "ents")
    got = surrogates.assign(e).collect()
    assert len(got) == len(names) == len({r.surrogate for r in got})
    assert not {r.surrogate for r in got} & {f"{x}@q.com" for x in names}
    assert all(r.surrogate == surrogates.surrogate(surrogates.KEY, r.kind, r.entity, r.attempt) for r in got)
    assert max(r.attempt for r in got) > 0


def test_pseudonymise(spark, odd, odd_rows, nothing):
    docs = odd.withColumn("text", F.when(F.col("doc_id") == 7, F.lit(TEXT)).when(F.col("doc_id") == 11, F.lit("a@b.cd c@b.cd"))
                          .otherwise(F.col("text")))
    one = sorted(map(str, surrogates.pseudonymise(docs).collect()))
    other = sorted(map(str, surrogates.pseudonymise(docs, broadcast_rows=0).collect()))
    assert len(one) == len(odd_rows) and one == other
    clean = {r.id: r.text for r in surrogates.pseudonymise(docs).where("size(kinds) = 0 and id is not null").collect()}
    src = {i: t or "" for i, t, *_ in odd_rows}
    assert all(src[i] == t for i, t in clean.items() if i not in (10, 11))
    assert surrogates.pseudonymise(nothing).count() == 0


def test_passage_seeds_are_not_held_three_times():
    from sparktab.llm import passages

    rng = np.random.default_rng(3)
    held = [(rng.integers(0, 50, 200).astype(np.uint64), np.full(200, i, np.int64), np.arange(200, dtype=np.int32),
             np.full(200, 4, np.int32), np.zeros(200, np.uint32)) for i in (2, 1)]
    want = sorted(zip(*(np.concatenate(c).tolist() for c in zip(*held))))
    h, d, p, n, s = passages.sorted_rows(held)
    assert not held and [c.dtype.itemsize for c in (h, d, p, n, s)] == [8, 8, 4, 4, 4]
    assert list(zip(h.tolist(), d.tolist(), p.tolist(), n.tolist(), s.tolist())) == want
    new, first, before = passages._runs(h, d, p, n, s)
    links = passages.match(h, d, p, n, s, first, before, passages.K)
    assert [c.dtype.itemsize for c in links] == [8, 4, 8, 4, 4]


def test_quality_counts_short_texts_in_small_lots():
    from sparktab.llm import quality

    texts = [bytes([97 + i % 26]) * 1000 for i in range(5000)]
    lots = list(quality.grams(texts, 5))
    assert max(len(code) for code, _ in lots) < 1.1 * (1 << 20)
    assert sum(len(code) for code, _ in lots) == 5_000_000


def test_encoder_keeps_pieces_outside_python(tokenizer):
    """A word met before is neither encoded again nor held as a Python string, so that far more words can be kept."""
    e = tokenfile.Encoder(tokenfile.tokenizer_path())
    first, again = ["Some words, kept for long.", "", "two  spaces\nand lines"], ["kept words, and new ones.", "words kept"]
    for texts in (first, again, again + first):
        ids, counts = e.encode(texts)
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
    assert not e.index and "words" in e.words.to_pylist()
    assert len(e.words) == len(set(e.words.to_pylist())) == len(e.start) - 1

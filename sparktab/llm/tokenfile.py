"""Operator 3: token ids in binary files: frequency ranks in byte-aligned variable-length coding.

Writing, in ascending order of the id column:

1. The rows are range-partitioned and sorted by id; each task encodes its texts
   (an end id after each) and keeps them as blocks of at most about ``block_tokens`` ids.
2. The ids are counted over all blocks; rank 0 is the most frequent id (ties: the
   smaller id).  The rank table has at most as many rows as the vocabulary.
3. Every block becomes one file.  A rank takes 1 to 4 bytes; its length minus one is
   a 2-bit code, four codes to a control byte, and control bytes stand apart from
   data bytes, so that decoding needs no branches: a table lookup per control
   byte gives four lengths, their running sum the places of the data.

File: 8 bytes magic; five little-endian int64: documents, ids, place of the first id
in the whole corpus, data bytes, size of the rank table; then document ids (int64),
validity (uint8), ids per document (int64), rank table (uint32), control, data.
Each file can be read alone.  Files appear under their final name by one rename, so a
task that runs twice leaves one complete file.

Texts are encoded as the library does by default: the string of a special token in a text
becomes that token's id.

Defined results: null text counts as empty (just the end id); null ids come first;
rows with equal id are ordered by their text's hash; an empty table writes no
file; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from array import array
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktab.session import scratch_path

from .common import col, discard, saved, text_hash

MAGIC = b"TOKRANK1"
TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_TOKENS = 2_000_000
CACHE_WORDS = 1_500_000  # kept in Arrow and plain arrays, some 50 bytes each
BATCH_BYTES = 8_000_000
LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], np.uint8)  # by control byte


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts with a byte-level BPE; ids of words are kept, as most words come again.

    The BPE never merges across the cut before a single space that stands between two
    non-space characters, nor between a run of letters and the full stops or commas
    behind it, so texts are cut there and only distinct pieces are encoded.  A piece is
    known by its text without the space before it; the first of a text, which has none,
    by a line feed and its text (no other piece starts with white space).
    """

    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(names.values()) + 1, bool)
        self.kind = np.uint16 if len(self.spaced) <= 1 << 16 else np.uint32
        self.spaced[[i for name, i in names.items() if name.startswith("\u0120")]] = True  # a space byte
        self.clear()

    def clear(self):
        self.index: dict[str, int] = {}  # numbers of the pieces learned last, and of their parts
        self.words, self.added = pa.array([], pa.large_string()), []  # all pieces by number, and those to follow them
        self.flat, self.start = array("i"), array("q", [0])

    def _keep(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.start) - 1
        self.index.update(zip(keys, range(n, n + len(keys))))
        self.added.append(pa.array(keys, pa.large_string()))
        self.start.frombytes((len(self.flat) + np.cumsum(sizes, dtype=np.int64)).tobytes())
        self.flat.frombytes(ids.astype(np.int32).tobytes())

    def _one_by_one(self, keys: list[str]) -> None:
        text = [w[1:] if w[0] == "\n" else " " + w for w in keys]
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(text, add_special_tokens=False)]
        self._keep(keys, np.fromiter(chain.from_iterable(ids), np.int32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def _learn(self, new: set[str]) -> None:
        other = [w for w in new if not w.isalpha()]
        cores = [w.rstrip(".,") for w in other]
        joined = [(w, core, "\n" + w[len(core):]) for w, core in zip(other, cores) if core.isalpha()]
        other = [w for w, core in zip(other, cores) if not core.isalpha()]
        rest = [w for w in other if w[0].isspace() or len(w.split()) > 1]
        plain = {w for w in new if w.isalpha()}.union((core for _, core, _ in joined), set(other).difference(rest))
        parts = pa.array({part for _, core, tail in joined for part in (core, tail)}, pa.large_string())
        self.index = {w: i for w, i in zip(parts.to_pylist(), self._find(parts).tolist()) if i >= 0}
        rest += {tail for _, _, tail in joined}.difference(self.index, rest)
        # words without white space of their own are encoded as one text; each starts a token with a space
        plain = list(plain.difference(self.index))
        lines = [plain[at:at + 512] for at in range(0, len(plain), 512)]
        found = self.tokenizer.encode_batch_fast([" " + " ".join(p) for p in lines], add_special_tokens=False)
        for part, e in zip(lines, found):
            ids = np.array(e.ids, np.int32)
            first = np.flatnonzero(self.spaced[ids])
            if len(first) == len(part) and first[0] == 0:
                self._keep(part, ids, np.diff(np.r_[first, len(ids)]))
            else:
                rest += part
        if rest:
            self._one_by_one(rest)
        if joined:
            names, cores, tails = zip(*joined)
            at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(zip(cores, tails))), np.int64, 2 * len(names))
            ids, size = self._gather(at)
            self._keep(list(names), ids, size.reshape(-1, 2).sum(axis=1))

    def _find(self, names: pa.Array) -> np.ndarray:
        """The numbers of pieces, -1 for those not known yet."""
        if self.added:
            self.words, self.added = pa.concat_arrays([self.words, *self.added]), []
        at = pc.index_in(names, value_set=self.words)
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def _gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by number, one after the other, and how many each has."""
        start = np.frombuffer(self.start, np.int64)
        first = start[which]
        size = start[which + 1] - first
        del start
        if not size.sum():
            return np.zeros(0, np.int32), size
        flat = np.frombuffer(self.flat, np.int32)
        out = flat[np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        del flat  # an array cannot grow while it is looked at
        return out, size

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number per text), without end ids."""
        if len(self.start) > CACHE_WORDS or len(self.flat) > 5 * CACHE_WORDS:
            self.clear()
        # a line break becomes a piece of its own, and what follows it one without a space
        given = pa.array(texts, pa.large_string())
        given = pc.if_else(pc.equal(pc.binary_length(given), 0), None, given)
        given = pc.replace_substring(given, "\n", " \n\n \n")
        given = pc.binary_join_element_wise(pa.scalar("\n", given.type), given, pa.scalar("", given.type))
        cut = pc.split_pattern(given, " ")
        words = pc.fill_null(pc.list_value_length(cut), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.list_flatten(cut).dictionary_encode()  # each occurrence is looked up once, in the batch's own pieces
        pieces, which = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        known = self._find(pieces)  # only pieces not known yet become Python strings
        fresh = pieces.filter(pa.array(known < 0)).to_pylist()
        # white space next to white space or at an end of the text: cut these texts with more care
        loose = {w for w in fresh if not w or w == "\n" or (w != "\n\n" and (
            w[-1].isspace() or (w[0].isspace() and (w[0] != "\n" or w[1].isspace()))))}
        if loose:
            names = pieces.to_pylist()
            number = {w: i for i, w in enumerate(names)}
            marked = np.zeros(len(names), bool)
            marked[[number[w] for w in loose]] = True
            doc = np.repeat(np.arange(len(texts)), words)
            again = np.flatnonzero(np.bincount(doc, marked[which], len(texts)))
            parts = []
            for i in again.tolist():
                part = self.CUT.split(texts[i])
                part[0] = "\n" + part[0]
                parts.append([number.setdefault(w, len(number)) for w in part])
            redone = np.zeros(len(texts), bool)
            redone[again] = True
            stay = ~redone[doc]
            words[again] = [len(part) for part in parts]
            more = np.fromiter(chain.from_iterable(parts), np.int64, words[again].sum())
            order = np.argsort(np.r_[doc[stay], np.repeat(again, words[again])], kind="stable")
            which = np.r_[which[stay], more][order]
            names = list(number)
            used = np.bincount(which, minlength=len(names)) > 0
            names = [w if u else "\n\n" for w, u in zip(names, used.tolist())]  # pieces that no text has any more
            known = self._find(pa.array(names, pa.large_string()))
            fresh = [w for w, k in zip(names, known.tolist()) if k < 0]
        self._learn(set(fresh))
        known[known < 0] = np.fromiter(map(self.index.__getitem__, fresh), np.int64, len(fresh))
        out, size = self._gather(known[which])
        counts = np.bincount(np.repeat(np.arange(len(texts)), words), size, len(texts)).astype(np.int64)
        return out, counts


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    return Encoder(path)


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit ranks."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    code = ((ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= code[:, None]]
    code = np.r_[code, np.zeros(-len(code) % 4, np.uint8)].reshape(-1, 4)
    return code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6, data


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of ``pack``."""
    size = LENGTHS[control].reshape(-1)[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    out = data[at].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= data[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids, valid, counts, ids, start: int, by_rank: np.ndarray, rank_of: np.ndarray) -> bytes:
    control, data = pack(rank_of[ids])
    head = np.array([len(doc_ids), len(ids), start, len(data), len(by_rank)], "<i8")
    return b"".join((MAGIC, head.tobytes(), doc_ids.astype("<i8").tobytes(), valid.astype(np.uint8).tobytes(),
                     counts.astype("<i8").tobytes(), by_rank.astype("<u4").tobytes(), control.tobytes(), data.tobytes()))


def read_file(raw: bytes):
    """(document ids, validity, starts in the corpus, counts, ids) of one file."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, n, start, size, vocab = np.frombuffer(raw, "<i8", 5, 8).tolist()
    at = 48

    def take(kind, count):
        nonlocal at
        out = np.frombuffer(raw, kind, count, at)
        at += out.nbytes
        return out

    doc_ids, valid, counts, by_rank = take("<i8", docs), take(np.uint8, docs), take("<i8", docs), take("<u4", vocab)
    ids = by_rank[unpack(take(np.uint8, -(-n // 4)), take(np.uint8, size), n)] if n else np.zeros(0, "<u4")
    return doc_ids, valid, start + np.cumsum(counts) - counts, counts, ids


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else os.path.abspath(uri))


def _put(uri: str, name: str, raw: bytes) -> None:
    """Write a file under its final name in one step."""
    fs, folder = _file_system(uri)
    temp, final = f"{folder}/.{name}.{uuid.uuid4().hex}", f"{folder}/{name}"
    with fs.open_output_stream(temp) as f:
        f.write(raw)
    fs.move(temp, final)


def _blocks(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int, block_tokens: int) -> DataFrame:
    src = (docs.select(col(id_col).cast("long").alias("id"), text_hash(text_col).alias("h"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
           .repartitionByRange("id", "h").sortWithinPartitions("id", "h"))

    def run(batches):
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), encoder_of(path)
        held, size, before, seq = [], 0, 0, 0

        def block():
            ids, counts = np.concatenate([h[2] for h in held]), np.concatenate([h[1] for h in held])
            doc = pa.concat_arrays([h[0] for h in held])
            valid = np.asarray(doc.is_valid()).astype(np.uint8)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part]), "seq": pa.array([seq]), "before": pa.array([before]),
                "n": pa.array([len(ids)]), "doc": pa.array([doc.fill_null(0).to_numpy().tobytes()]),
                "valid": pa.array([valid.tobytes()]), "counts": pa.array([counts.tobytes()]),
                "ids": pa.array([ids.astype(encoder.kind).tobytes()])})

        for b in batches:
            size_of, at = pc.binary_length(b.column(2)).to_numpy(), 0
            while at < b.num_rows:
                end, n = at + 1, int(size_of[at])
                while end < b.num_rows and n + size_of[end] <= BATCH_BYTES:
                    n += int(size_of[end])
                    end += 1
                ids, counts = encoder.encode(b.column(2).slice(at, end - at).to_pylist())
                ids = np.insert(ids, np.cumsum(counts), end_id)
                held.append((b.column(0).slice(at, end - at), counts + 1, ids))
                size += len(ids)
                at = end
                if size >= block_tokens:
                    yield block()
                    before, seq, held, size = before + size, seq + 1, [], 0
        if held:
            yield block()

    return src.mapInArrow(run, "part long, seq long, before long, n long, doc binary, valid binary, counts binary, ids binary")


def _ids_of(value, n: int) -> np.ndarray:
    """The ``n`` ids of a block's binary value, kept in two or four bytes each."""
    raw = value.as_buffer()
    return np.frombuffer(raw, np.uint16 if raw.size == 2 * n else np.uint32)


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str | None = None, end_id: int = END_ID, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the token files of ``docs`` into the shared ``folder`` (a path that every executor reaches)."""
    spark = docs.sparkSession
    _file_system(folder)[0].create_dir(_file_system(folder)[1], recursive=True)
    blocks = saved(_blocks(docs, id_col, text_col, tokenizer or tokenizer_path(), end_id, block_tokens), "token-blocks")

    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            for x, k in zip(b.column(0), b.column(1).to_pylist()):
                n = np.bincount(_ids_of(x, k))
                if len(n) > len(total):
                    n, total = total, n.astype(np.int64)
                total[:len(n)] += n
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["token", "n"])

    # at most one row per id of the vocabulary
    ranked = (blocks.select("ids", "n").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
              .orderBy(F.desc("n"), "token").select("token").toArrow())
    by_rank = ranked.column(0).to_numpy().astype(np.uint32)
    rank_of = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    tables = spark.sparkContext.broadcast((by_rank, rank_of))

    parts = blocks.groupBy("part").agg(F.sum("n").alias("n"))  # one row per task
    base = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))

    def put(batches):
        by_rank, rank_of = tables.value
        for b in batches:
            c = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                get = lambda n, kind: np.frombuffer(c[n][i].as_buffer(), kind)
                ids = _ids_of(c["ids"][i], c["n"][i].as_py())
                raw = file_bytes(get("doc", np.int64), get("valid", np.uint8), get("counts", np.int64), ids,
                                 c["base"][i].as_py() + c["before"][i].as_py(), by_rank, rank_of)
                name = f"part-{c['part'][i].as_py():06d}-{c['seq'][i].as_py():06d}.tok"
                _put(folder, name, raw)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(raw)]), pa.array([len(ids)])],
                                                 ["file", "bytes", "ids"])

    done = blocks.join(F.broadcast(base), "part").mapInArrow(put, "file string, bytes long, ids long")
    saved(done, "token-manifest")
    discard(blocks)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("content")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: id, start, ids (array of long), from the files."""

    def run(batches):
        for b in batches:
            for x in b.column(0):
                doc, valid, start, counts, ids = read_file(x.as_buffer().to_pybytes())
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)),
                                                 pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(doc, mask=valid == 0), pa.array(start), lists],
                                                 ["id", "start", "ids"])

    return _files(spark, folder).mapInArrow(run, "id long, start long, ids array<long>")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit), from the files."""

    def run(batches):
        for b in batches:
            for x in b.column(0):
                doc, valid, start, counts, ids = read_file(x.as_buffer().to_pybytes())
                raw, ends = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B"), 4 * np.cumsum(counts)
                crc = [zlib.crc32(raw[e - 4 * n:e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, mask=valid == 0), pa.array(start), pa.array(counts), pa.array(crc, pa.int64())],
                    ["id", "start", "n_tokens", "ids_crc32"])

    return _files(spark, folder).mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "tokens")

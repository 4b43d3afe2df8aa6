"""Operator 4: SentencePiece encoding by forward filtering and backward sampling, and lossless decoding.

A text is cut before each run of spaces (no piece has a space after another
character), so its piece lattice falls apart into words.  The distinct words of a
batch are worked on together with numpy:

* arcs: every substring that is a piece, found by hash and then compared;
  a character without a piece becomes its UTF-8 bytes (byte fallback);
* forward filtering: log-sum-exp over the arcs into every node, position by position;
* backward sampling: from the end of every occurrence of a word, an arc is drawn
  with its posterior probability until the start is reached.

The draw at a character of a row depends only on (seed, row key, position), so a
row gets the same segmentation in any batch, partition or rerun.  A piece's
log-probability is its score for unigram models; for BPE models, whose score is
minus the merge rank, it is -log(rank + 2) (frequency falls with rank).  ``theta``
scales it: larger is closer to the best segmentation.

Decoding joins the pieces' bytes and drops the leading space that encoding
added.  It gives the text back byte by byte: the model's normaliser is not used, a
literal U+2581 goes through byte fallback, and control pieces are never emitted.

Defined results: null text counts as empty and has no ids; equal rows get equal
ids; empty table, empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, text_hash

MODEL = "piece_bpe_32k.model"
THETA = 4.0
SEED = 4
BATCH_BYTES = 1_500_000
SPACE, LITERAL = 0x2581, 0x110000  # U+2581 from a space; U+2581 in the text itself
BASE = np.uint64(0x9E3779B97F4A7C15)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """The pieces of a model as arrays: hashes for lookup, log-probabilities, bytes for decoding."""

    def __init__(self, path: str, theta: float = THETA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        score = np.array([sp.get_score(i) for i in range(n)])
        byte = {i for i in range(n) if sp.is_byte(i)}
        plain = [i for i in range(n) if i not in byte
                 and not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)) and names[i]]
        if any("▁" in names[i].lstrip("▁") for i in plain):
            raise ValueError("pieces with a space after another character are not supported")
        ranked = score[plain].min() < -1000  # BPE: minus the merge rank
        if any("\0" in names[i] for i in plain):
            raise ValueError("pieces with a null character are not supported")
        single = [i for i in plain if len(names[i]) == 1]
        self.logp = np.full(n, -np.inf)
        self.logp[plain] = theta * (-np.log(2 - score[plain]) if ranked else score[plain])
        self.fallback = self.logp[single].min() - 1.0
        self.byte_id = np.zeros(256, np.int64)
        for i in byte:
            self.byte_id[int(names[i][3:5], 16)] = i
        self.longest = max(len(names[i]) for i in plain)
        self.chars = np.zeros((n, self.longest), np.uint32)
        for i in plain:
            cps = np.frombuffer(names[i].encode("utf-32-le"), np.uint32)
            self.chars[i, :len(cps)] = cps
        # for every length, the hashes of all prefixes of pieces; the piece's id where the prefix is one, else -1
        self.tables = {}
        lens = (self.chars > 0).sum(axis=1)
        h = np.zeros(n, np.uint64)
        for length in range(1, self.longest + 1):
            h = h * BASE + self.chars[:, length - 1].astype(np.uint64)
            at = np.flatnonzero(lens >= length)
            at = at[np.argsort(lens[at], kind="stable")]  # a piece before longer ones with this prefix
            keys, first = np.unique(h[at], return_index=True)
            ids = np.where(lens[at[first]] == length, at[first], -1).astype(np.int32)
            if (ids >= 0).sum() != (lens == length).sum():
                raise ValueError("two pieces share a hash")
            self.tables[length] = (keys, ids)
        raw = [bytes([int(names[i][3:5], 16)]) if i in byte else
               names[i].replace("▁", " ").encode() if i in set(()) or np.isfinite(self.logp[i]) else b""
               for i in range(n)]
        self.raw_len = np.fromiter(map(len, raw), np.int64, n)
        self.raw_at = np.cumsum(self.raw_len) - self.raw_len
        self.raw = np.frombuffer(b"".join(raw), np.uint8)

    def arcs(self, cp: np.ndarray, left: np.ndarray):
        """Arcs (from, length, piece) over characters ``cp``; ``left``: characters to the word's end."""
        at, h = np.arange(len(cp), dtype=np.int32), np.zeros(len(cp), np.uint64)
        out, known = [], np.zeros(len(cp), bool)
        for length in range(1, self.longest + 1):
            ok = left[at] >= length
            at, h = at[ok], h[ok]
            if not len(at):
                break
            h = h * BASE + cp[at + length - 1].astype(np.uint64)
            keys, ids = self.tables[length]
            pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[pos] == h  # only what begins some piece is followed further
            at, h, piece = at[hit], h[hit], ids[pos[hit]]
            whole = piece >= 0
            start, piece = at[whole], piece[whole]
            same = np.ones(len(start), bool)
            for k in range(length):
                same &= cp[start + k] == self.chars[piece, k]
            start, piece = start[same], piece[same]
            out.append((start, np.full(len(start), length, np.int32), piece))
            if length == 1:
                known[start] = True
        lone = np.flatnonzero(~known).astype(np.int32)
        out.append((lone, np.ones(len(lone), np.int32), self.size + cp[lone].astype(np.int32)))
        return tuple(np.concatenate(x) for x in zip(*out))

    def expand(self, ids: np.ndarray, owner: np.ndarray):
        """Replace characters without a piece by their byte pieces."""
        odd = ids >= self.size
        if not odd.any():
            return ids, owner
        times, table = np.ones(len(ids), np.int64), {}
        for x in np.unique(ids[odd]).tolist():
            c = x - self.size
            table[x] = self.byte_id[list(chr(SPACE if c == LITERAL else c).encode("utf-8", "surrogatepass"))]
        for x, b in table.items():
            times[ids == x] = len(b)
        out, first = np.repeat(ids, times), np.cumsum(times) - times
        for x, b in table.items():
            at = first[ids == x]
            for k, v in enumerate(b):
                out[at + k] = v
        return out, np.repeat(owner, times)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text (UTF-8) of one row's ids."""
        if not len(ids):
            return b""
        size = self.raw_len[ids]
        shift = self.raw_at[ids] - (np.cumsum(size) - size)
        return self.raw[np.repeat(shift, size) + np.arange(size.sum())].tobytes()[1:]


class Lattices:
    """Piece lattices of distinct words, filtered forwards; nodes are numbered word after word."""

    def __init__(self, pieces: Pieces, words: list[str]):
        size = np.fromiter(map(len, words), np.int64, len(words))
        cp = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        cp[cp == SPACE] = LITERAL
        cp[cp == 32] = SPACE
        ends = np.cumsum(size)
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        start, length, piece = pieces.arcs(cp, ends[word] - np.arange(len(cp)))
        w = word[start]
        tail = start + w              # a word of n characters has n + 1 nodes
        head = tail + length
        logw = np.where(piece < pieces.size, pieces.logp[np.minimum(piece, pieces.size - 1)], pieces.fallback)
        step = start + length - (ends - size).astype(np.int32)[w]
        order = np.argsort(head, kind="stable")
        tail, head, piece, logw, step = tail[order], head[order], piece[order], logw[order], step[order]
        alpha = np.zeros(len(cp) + len(words))
        prob = np.empty(len(tail))
        narrow = step.astype(np.int16) if len(step) and step.max() < 1 << 15 else step
        by_step = np.argsort(narrow, kind="stable")
        s = step[by_step]
        cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1], True]) if len(s) else np.zeros(1, int)
        for lo, hi in zip(cuts[:-1], cuts[1:]):  # all arcs that end at the same position of their word
            at = by_step[lo:hi]
            h, v = head[at], alpha[tail[at]] + logw[at]
            first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
            count = np.diff(np.r_[first, len(h)])
            v -= np.repeat(top := np.maximum.reduceat(v, first), count)
            np.exp(v, out=v)
            total = np.add.reduceat(v, first)
            alpha[h[first]] = top + np.log(total)
            prob[at] = v / np.repeat(total, count)
        self.tail, self.piece = tail, piece
        if len(head):
            first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]])
            run = np.cumsum(prob)
            run -= np.repeat(run[first] - prob[first], np.diff(np.r_[first, len(head)]))
            run[np.r_[first[1:], len(head)] - 1] = 1.0
            self.bound = head + np.minimum(run, 1.0)
        else:
            self.bound = np.zeros(0)
        self.first = ends - size + np.arange(len(words))
        self.last = self.first + size

    def sample(self, which: np.ndarray, key: np.ndarray, offset: np.ndarray):
        """Pieces of occurrences of words: (pieces in order, number per occurrence)."""
        node, begin = self.last[which], self.first[which]
        live = np.arange(len(which))
        drawn, count = [], np.zeros(len(which), np.int64)
        while len(live):
            u = uniform(key[live], offset[live] + (node - begin[live]).astype(np.uint64))
            arc = np.searchsorted(self.bound, node + u, side="right")
            drawn.append((live, self.piece[arc]))
            count[live] += 1
            node = self.tail[arc]
            more = node > begin[live]
            live, node = live[more], node[more]
        out, at = np.zeros(count.sum(), np.int64), np.cumsum(count) - 1
        for k, (who, piece) in enumerate(drawn):
            out[at[who] - k] = piece
        return out, count


def uniform(key: np.ndarray, counter: np.ndarray) -> np.ndarray:
    """Counter-based random numbers in [0, 1): a 64-bit mix of key and counter."""
    z = key + (counter + np.uint64(1)) * BASE
    z = (z ^ z >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ z >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(np.float64) * (1 - 2.0 ** -40) / 2.0 ** 53


def words_of(text: str) -> list[str]:
    """The text, after a leading space, cut before every run of spaces."""
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return [" " + w for w in text.split(" ")]
    return re.findall(" +[^ ]*", " " + text)


def encode_batch(pieces: Pieces, texts: list[str], keys: np.ndarray) -> list[np.ndarray]:
    """Sampled ids of each text; ``keys``: one unsigned 64-bit key per row."""
    index: dict[str, int] = {}
    which, per_text = [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        ws = words_of(t)
        per_text[i] = len(ws)
        which.extend([index.setdefault(w, len(index)) for w in ws])
    if not which:
        return [np.zeros(0, np.int32)] * len(texts)
    words = list(index)
    which = np.array(which)
    size = np.fromiter(map(len, words), np.int64, len(words))[which]
    row = np.repeat(np.arange(len(texts)), per_text)
    offset = np.cumsum(size) - size
    first = np.cumsum(per_text) - per_text
    offset -= np.repeat(offset[np.minimum(first, len(offset) - 1)], per_text)
    ids, count = Lattices(pieces, words).sample(which, keys[row], offset.astype(np.uint64))
    ids, owner = pieces.expand(ids, np.repeat(row, count))
    return np.split(ids.astype(np.int32), np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])


@functools.lru_cache(maxsize=4)
def pieces_of(path: str, theta: float) -> Pieces:
    return Pieces(path, theta)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           theta: float = THETA, seed: int = SEED) -> DataFrame:
    """Per row: id, text_hash, ids (array of int).  ``model``: path of a model file, the same on every executor."""
    path = model or model_path()
    src = docs.select(col(id_col).alias("id"), F.xxhash64(F.lit(seed), col(id_col)).alias("key"),
                      text_hash(text_col).alias("text_hash"),
                      F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = src.schema["id"].simpleString().split(":", 1)[1]

    def run(batches):
        pieces = pieces_of(path, theta)
        for b in batches:
            size, at = pc.binary_length(b.column(3)).to_numpy(), 0
            keys = b.column(1).to_numpy().view(np.uint64)
            while at < b.num_rows:
                end, n = at + 1, int(size[at])
                while end < b.num_rows and n + size[end] <= BATCH_BYTES:
                    n += int(size[end])
                    end += 1
                ids = encode_batch(pieces, b.column(3).slice(at, end - at).to_pylist(), keys[at:end])
                offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), b.column(2).slice(at, end - at),
                                                  values], ["id", "text_hash", "ids"])
                at = end

    return src.mapInArrow(run, f"id {id_type}, text_hash long, ids array<int>")


def decode(tokens: DataFrame, model: str | None = None) -> DataFrame:
    """Per row of ``tokens`` (id, text_hash, ids): the same and the text; ``lossless`` compares its hash."""
    path = model or model_path()
    id_type = tokens.schema["id"].simpleString().split(":", 1)[1]

    def run(batches):
        pieces = pieces_of(path, THETA)
        for b in batches:
            ids = b.column(2)
            flat, off = ids.values.to_numpy(), ids.offsets.to_numpy()
            texts = pa.array([pieces.decode(flat[i:j]).decode("utf-8", "surrogatepass")
                              for i, j in zip(off[:-1], off[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids, texts], ["id", "text_hash", "ids", "text"])

    out = tokens.select("id", "text_hash", "ids").mapInArrow(
        run, f"id {id_type}, text_hash long, ids array<int>, text string")
    return out.withColumn("lossless", F.xxhash64("text") == F.col("text_hash"))

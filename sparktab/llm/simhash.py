"""Operator 8: SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprint: words are maximal runs of non-white-space bytes after lower-casing
A-Z; every run of ``shingle`` words (repeats included) is hashed with XXH64,
seed 42; a bit is set if it is set in more than half of the hashes.

Search within ``radius`` r: every distinct fingerprint emits all variants within
half the radius (h = r // 2 flips), so two fingerprints at most 2h apart meet in a
shared variant.  For an odd radius one more difference must be absorbed: the 64
bits are cut into three blocks, and the variants are emitted once per block with
that block's bits left out of the key.  Three differences always put exactly one
bit, or all three, into some block:

* one bit in block j: the other two lie outside, so the pair meets under block j
  with block parts one flip apart;
* all three in block j: the pair meets under block j with equal outside parts.

Within a key, members with equal block parts are at most 2h apart and are linked
in a chain; block parts one flip apart are found by looking the flips up; equal
outside parts are compared directly, or by looking up all flips when there are
many.  So the work in a key grows with its members, not with their square, and
every pair that is linked has been checked.  Exact copies are merged before any
variant is emitted.

Defined results: null text counts as empty, its fingerprint is zero and is
linked like any other; fewer words than ``shingle`` make one shingle; rows with
equal id or text keep one result row each; empty table, empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, keep_rows, saved, text_hash
from .components import components

SHINGLE = 3
RADIUS = 3
CHUNK = 1 << 16  # hashes whose bits are counted at once
DIRECT = 1500    # up to so many equal outside parts are compared pair by pair


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    k = min(shingle, len(words))
    starts, ends = (ends - size)[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), CHUNK):
        h = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])],
                     np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """Per row: id, text_hash, fp (the fingerprint as a signed long)."""
    src = docs.select(col(id_col).alias("id"), text_hash(text_col).alias("text_hash"),
                      col(text_col).cast("string").alias("text"))

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             ["id", "text_hash", "fp"])

    schema = src.schema["id"].simpleString().split(":", 1)[1]
    return src.mapInArrow(run, f"id {schema}, text_hash long, fp long")


def blocks(radius: int) -> list[int]:
    """Bit masks left out of the key: none for an even radius, three blocks for an odd one."""
    if radius % 2 == 0:
        return [0]
    cuts = (0, 21, 42, 64)
    return [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(nodes: DataFrame, radius: int) -> DataFrame:
    """Rows (j, v, x): fingerprint ``x`` has variant ``v`` (block ``j`` left out)."""
    half, moves = radius // 2, []
    for j, mask in enumerate(blocks(radius)):
        free = [b for b in range(64) if not mask >> b & 1]
        for n in range(half + 1):
            for flips in combinations(free, n):
                moves.append((j, _signed(sum(1 << b for b in flips)), _signed(~mask & (1 << 64) - 1)))
    m = F.explode(F.array(*[F.struct(F.lit(j).cast("tinyint").alias("j"), F.lit(f).cast("long").alias("f"),
                                     F.lit(k).cast("long").alias("k")) for j, f, k in moves]))
    return nodes.select("fp", m.alias("m")).select(
        F.col("m.j").alias("j"), F.col("fp").bitwiseXOR(F.col("m.f")).bitwiseAND(F.col("m.k")).alias("v"),
        F.col("fp").alias("x"))


def links_of_runs(j: np.ndarray, v: np.ndarray, x: np.ndarray, radius: int) -> np.ndarray:
    """Links (n, 2) among members ``x`` of the keys (j, v); rows sorted by (j, v)."""
    none = np.zeros((0, 2), np.uint64)
    if len(x) < 2:
        return none
    new = np.r_[True, (j[1:] != j[:-1]) | (v[1:] != v[:-1])]
    run = np.cumsum(new) - 1
    many = np.bincount(run)[run] > 1
    j, v, x, run = j[many], v[many], x[many], run[many]
    if not len(x):
        return none
    out = []
    for jj, mask in enumerate(blocks(radius)):
        at = j == jj
        if not at.any():
            continue
        xs, vs, rs, m = x[at], v[at], run[at].astype(np.uint64), np.uint64(mask)
        low = np.uint64((mask & -mask).bit_length() - 1 if mask else 0)
        width = bin(mask).count("1")
        code = rs << np.uint64(width) | (xs & m) >> low
        order = np.argsort(code, kind="stable")
        code, xs, vs, rs = code[order], xs[order], vs[order], rs[order]
        same = code[1:] == code[:-1]
        out.append(np.c_[xs[:-1][same], xs[1:][same]])  # equal block parts: at most 2 * half apart
        if radius % 2 == 0:
            continue
        first = np.r_[True, ~same]
        ucode, rep = code[first], xs[first]
        for b in range(width):  # block parts one flip apart: at most 2 * half + 1 apart
            lower = np.flatnonzero(ucode >> np.uint64(b) & np.uint64(1) == 0)
            want = ucode[lower] | np.uint64(1 << b)
            pos = np.minimum(np.searchsorted(ucode, want), len(ucode) - 1)
            hit = ucode[pos] == want
            out.append(np.c_[rep[lower[hit]], rep[pos[hit]]])
        zero = (xs & ~m) == vs  # equal outside parts, up to ``radius`` flips inside the block
        out.append(_inside(code[zero], xs[zero], rs[zero], width, radius))
    found = np.concatenate(out)
    return np.unique(np.c_[found.min(axis=1), found.max(axis=1)], axis=0) if len(found) else none


def _inside(code: np.ndarray, xs: np.ndarray, rs: np.ndarray, width: int, radius: int) -> np.ndarray:
    """Links among members of one run whose outside parts are equal (rows sorted by code)."""
    out = [np.zeros((0, 2), np.uint64)]
    sizes = np.unique(rs, return_counts=True)
    big = np.isin(rs, sizes[0][sizes[1] > DIRECT])
    c, x, r = code[~big], xs[~big], rs[~big]
    step = 1
    while len(x) > step and (near := r[step:] == r[:-step]).any():
        a, b = x[:-step][near], x[step:][near]
        hit = np.bitwise_count(a ^ b) <= radius
        out.append(np.c_[a[hit], b[hit]])
        step += 1
    c, x = code[big], xs[big]
    if len(x):
        for n in range(2, radius + 1):
            for flips in combinations(range(width), n):
                want = c ^ np.uint64(sum(1 << b for b in flips))
                pos = np.minimum(np.searchsorted(c, want), len(c) - 1)
                hit = (c[pos] == want) & (c < want)
                out.append(np.c_[x[hit], x[pos[hit]]])
    return np.concatenate(out)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints at most ``radius`` bits apart.

    Not every such pair is listed, but any two are joined by a path of listed links.
    """
    rows = variants(nodes, radius).repartition("j", "v").sortWithinPartitions("j", "v")

    def run(batches):
        held = None
        for b in batches:
            now = [b.column(0).to_numpy(False), b.column(1).to_numpy(False).view(np.uint64),
                   b.column(2).to_numpy(False).view(np.uint64)]
            if held is not None:
                now = [np.concatenate(p) for p in zip(held, now)]
            # the last key may go on in the next batch
            cut = int(np.flatnonzero((now[0] == now[0][-1]) & (now[1] == now[1][-1]))[0]) if len(now[0]) else 0
            yield from batch(*(p[:cut] for p in now))
            held = [p[cut:] for p in now]
        if held is not None:
            yield from batch(*held)

    def batch(j, v, x):
        found = links_of_runs(j, v, x, radius).view(np.int64)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs``: id, text_hash, fingerprint (hex), component_id (smallest id reachable), root.

    ``root`` names the component even where ids are null or occur in two components.
    """
    fps = saved(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = saved(fps.groupBy("fp").agg(F.min("id").alias("low")), "fp-nodes")
    found = components(links(nodes, radius))
    labelled = nodes.join(found, nodes["fp"] == found["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("low").alias("component_id"))
    where = saved(labelled.join(least, "root").select(F.col("fp").alias("n_fp"), "root", "component_id"), "fp-components")
    return fps.join(where, fps["fp"] == where["n_fp"]).select(
        "id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def near_dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group (the smallest id; ties by text hash), with all columns of ``docs``."""
    found = simhash_components(docs, id_col, text_col, shingle, radius)
    best = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("n"), "id", "text_hash")).alias("best"))
    keys = best.select(F.col("best.id").alias("k_id"), F.col("best.text_hash").alias("k_hash"))
    return keep_rows(docs, keys, id_col, text_col, once=True)

"""Train/test splitting.

* ``hash_split`` (L1, L3, L4): stateless threshold on a seeded key hash.
* ``exact_split`` (L1, exact size): ``ceil(n * f)`` test rows, no global sort.
* ``stratified_split`` (L2): per-stratum exact cut.  The k-th smallest hash of a
  stratum is found with a two-level radix select over small aggregates, so no
  stratum is ever sorted or gathered in one task, however large it is.
* ``manifest_split`` (L5): join rows to a saved ``(key, side)`` table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_u32, threshold
from ..session import local_table

SIDE = "split"
TRAIN, TEST, VALID = "train", "test", "validation"
# Radix select over 32-bit hashes: the high 12 bits (<= 4096 groups per stratum), then
# the next 12, then the last 8 of the hashes inside the one bucket that holds the cut.
_HIGH, _MID = 20, 8
ROW_BYTES = 64        # of a broadcast row beside its values
MAX_STRATA = 100_000  # so many cut rows are broadcast; more are joined


def hash_split(df: DataFrame, keys: Sequence[str], test_fraction: float, seed: int,
               validation_fraction: float = 0.0, side_col: str = SIDE) -> DataFrame:
    """Tag each row ``train``/``test`` (and optionally ``validation``).

    ``test`` holds hashes below ``test_fraction * 2^32``; ``validation`` takes the next
    ``validation_fraction`` of the *training* share.  Duplicate keys share a side.
    """
    h = hash_u32(keys, seed)
    cut_test = threshold(test_fraction)
    side = F.when(h < F.lit(cut_test), F.lit(TEST))
    if validation_fraction > 0:
        cut_valid = cut_test + int((threshold(1.0) - cut_test) * validation_fraction)
        side = side.when(h < F.lit(cut_valid), F.lit(VALID))
    return df.withColumn(side_col, side.otherwise(F.lit(TRAIN)))


def stratified_split(df: DataFrame, keys: Sequence[str], stratum: str, test_fraction: float,
                     seed: int, side_col: str = SIDE) -> DataFrame:
    """Exact per-stratum test share: the ``ceil(n_s * f)`` smallest hashes of each stratum.

    Rows whose hash ties the cut value (duplicate keys) all go to ``test``.
    Work: two aggregations over the data (map-side combined) plus broadcast
    joins against per-stratum cut tables of one row per stratum.
    """
    hashed = df.withColumn("_h", hash_u32(keys, seed))
    cuts = _stratum_cuts(hashed, stratum, test_fraction).select(F.col(stratum).alias("_s"), F.col("_h").alias("_cut"))
    cut_df = _few_or_joined(cuts)
    out = hashed.join(cut_df, hashed[stratum].eqNullSafe(cut_df["_s"]), "left")
    side = F.when(F.col("_cut").isNotNull() & (F.col("_h") <= F.col("_cut")),
                  F.lit(TEST)).otherwise(F.lit(TRAIN))
    return out.withColumn(side_col, side).drop("_h", "_s", "_cut")


def exact_split(df: DataFrame, keys: Sequence[str], test_fraction: float, seed: int,
                side_col: str = SIDE) -> DataFrame:
    """L1 with the reference's exact test size: the ``ceil(n * f)`` smallest hashes are ``test``.

    The radix select over one stratum: two small aggregates, no global sort;
    the single cut value is then applied as a literal (no join).  Ties with
    the cut hash also go to ``test``.
    """
    h = hash_u32(keys, seed)
    cut = _stratum_cuts(df.select(F.lit(0).alias("_all"), h.alias("_h")), "_all", test_fraction).first()
    if cut is None:  # empty input
        return df.withColumn(side_col, F.lit(TRAIN))
    return df.withColumn(side_col, F.when(h <= F.lit(cut["_h"]), F.lit(TEST)).otherwise(F.lit(TRAIN)))


def _stratum_cuts(hashed: DataFrame, stratum: str, test_fraction: float) -> DataFrame:
    """``(stratum, _h)``: per stratum, the hash of the ``ceil(n * f)``-th smallest row.

    Two aggregates over the rows; no window sees more than 4096 rows of a stratum.
    """
    hi, mid = F.shiftright(F.col("_h"), _HIGH), F.shiftright(F.col("_h"), _MID)
    lvl1 = hashed.groupBy(stratum, hi.alias("_hi")).agg(F.count(F.lit(1)).alias("_c"))
    need = F.ceil(F.sum("_c").over(Window.partitionBy(stratum)) * F.lit(test_fraction)).cast("bigint")
    cut1 = _few_or_joined(_first_reaching(lvl1, stratum, "_hi", need).select(
        F.col(stratum).alias("_s1"), F.col("_hi").alias("_cut_hi"), F.col("_need").alias("_k")))
    in_bucket = hashed.join(cut1, hashed[stratum].eqNullSafe(cut1["_s1"]) & (hi == cut1["_cut_hi"]))
    exact = in_bucket.groupBy(stratum, "_h", "_k").agg(F.count(F.lit(1)).alias("_c"))
    lvl2 = exact.groupBy(stratum, mid.alias("_m"), "_k").agg(F.sum("_c").alias("_c"))
    cut2 = _few_or_joined(_first_reaching(lvl2, stratum, "_m", F.col("_k")).select(
        F.col(stratum).alias("_s2"), F.col("_m").alias("_cut_m"), F.col("_need").alias("_k2")))
    last = exact.join(cut2, exact[stratum].eqNullSafe(cut2["_s2"]) & (mid == cut2["_cut_m"]))
    return _first_reaching(last, stratum, "_h", F.col("_k2")).select(stratum, "_h")


def _few_or_joined(cut: DataFrame) -> DataFrame:
    """One narrow row per stratum: broadcast below a checked number of strata, else joined as it is."""
    rows = cut.limit(MAX_STRATA + 1).collect()
    if len(rows) > MAX_STRATA:
        return cut
    return F.broadcast(local_table(cut.sparkSession, [tuple(r) for r in rows], cut.schema))


def _first_reaching(counts: DataFrame, stratum: str, order_col: str, k) -> DataFrame:
    """Row per stratum where the running count over ``order_col`` first reaches ``k``.

    ``counts`` is an aggregate (bounded rows per stratum), so the window is cheap.
    Adds ``_need``: how many rows of that bucket are still needed.
    """
    w = Window.partitionBy(stratum).orderBy(order_col)
    c = counts.withColumn("_cum", F.sum("_c").over(w)).withColumn("_kk", k)
    return (c.filter((F.col("_cum") >= F.col("_kk")) & (F.col("_cum") - F.col("_c") < F.col("_kk")))
            .withColumn("_need", F.col("_kk") - (F.col("_cum") - F.col("_c"))))


def manifest_split(df: DataFrame, manifest: DataFrame, key: str, side_col: str = SIDE,
                   max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Attach ``side`` from a saved ``(key, side)`` manifest (reproduces recorded splits).

    Rows whose key is not listed stay, with side null; a key listed several times
    counts once, and with different sides it is an error.  The manifest is broadcast
    only when its keys and sides, with ``ROW_BYTES`` for each row, are under the bound;
    otherwise both sides are shuffled on the key.
    """
    m = manifest.groupBy(F.col(key).alias("_key")).agg(F.min(side_col).alias(side_col), F.max(side_col).alias("_max"))
    size = F.lit(ROW_BYTES) + sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in ("_key", side_col)), F.lit(0))
    checked = m.agg(F.max(F.col(side_col) != F.col("_max")).alias("twice"), F.sum(size).alias("bytes")).first()  # one pass
    if checked["twice"]:
        raise ValueError(f"the manifest lists a {key} on two sides")
    m = m.select("_key", side_col)
    if (checked["bytes"] or 0) <= max_broadcast_bytes:
        m = F.broadcast(m)
    return df.join(m, F.col(key) == F.col("_key"), "left").drop("_key")


def materialize_split(df: DataFrame, path: str, side_col: str = SIDE) -> DataFrame:
    """Write a split table partitioned by side and read it back.

    For large inputs: the md5 predicate is not pushed into the scan, so later
    stages read only ``split=train`` / ``split=test`` folders (partition
    pruning), and the written table cuts lineage (a lost executor re-reads it
    instead of recomputing the scan and hash).  ``path`` belongs in the shared
    folder named by ``spark.checkpoint.dir``.
    """
    df.write.mode("overwrite").partitionBy(side_col).parquet(path)
    return df.sparkSession.read.parquet(path)

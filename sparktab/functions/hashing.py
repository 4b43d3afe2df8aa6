"""Portable, stateless row hashing for reproducible splits.

The hash of a row is the first 32 bits of ``md5(seed | key1 | key2 ...)`` read as
an unsigned integer in ``[0, 2^32)``.  It depends only on the key values, so it
is stable under repartitioning, executor loss and re-execution (unlike
``randomSplit``), and DuckDB computes the same number, which lets a split be
checked outside Spark.  Keys should be integers or strings: their text form is
identical in both engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def hash_u32(keys: Sequence[str], seed: int | str) -> Column:
    """Column expression: unsigned 32-bit md5 prefix of the seeded key string."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8), 16, 10).cast("bigint")


def threshold(fraction: float) -> int:
    """Hash values strictly below this integer form the ``fraction`` side."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be in [0, 1], got {fraction}")
    return int(fraction * HASH_SPACE)


def sql_hash_u32(keys: Sequence[str], seed: int | str) -> str:
    """The same hash as DuckDB SQL text (used by the oracle queries)."""
    parts = [f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys]
    return f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8)) AS BIGINT)"

"""Connected components by alternating large-star / small-star rounds on DataFrames.

Every round keeps the number of edges at or below the number before, and the
number of rounds grows with the logarithm of the largest component.  Only counts
come to the driver; minima are combined map-side, and the join that hands a
node's minimum to its edges may be split by AQE when one node has many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    low = low.select("u", F.least("u", "m").alias("m"))
    out = both.where("b > a").join(low, F.col("a") == F.col("u"))
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = down.join(low, F.col("a") == F.col("u")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (long columns ``a``, ``b``) to rows (node, root), root = smallest node of its component.

    Nodes without edges and roots themselves are not listed.
    """
    current = saved(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "edges")
    state = None
    for _ in range(max_rounds):
        after = saved(_small_star(_large_star(current)), "edges")
        now = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        discard(current)
        current = after
        if now[0] == 0 or tuple(now) == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(now)
    raise RuntimeError("components did not settle")

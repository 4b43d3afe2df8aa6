"""Small helpers shared by the operators of this package.

Row identity: ``doc_id`` need not be unique or non-null, so decisions about rows
travel under the pair (id, 64-bit hash of the text) and are joined null-safe.
Two rows with equal id and equal text are interchangeable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparktab.session import scratch_path

WS = r"[\x20\x09-\x0D]+"
NOT_WS = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*dfs: DataFrame) -> None:
    """Delete tables made by ``saved`` that nothing will read again."""
    for df in dfs:
        path = getattr(df, "_scratch", None)
        if path:
            spark = df.sparkSession
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def text_hash(text_col: str) -> Column:
    """64-bit hash of the text; null and empty texts are the same."""
    return F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit("")))


def keep_rows(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, once: bool) -> DataFrame:
    """Rows of ``docs`` whose (id, text hash) is in ``keys`` (columns ``k_id``, ``k_hash``; distinct).

    ``once``: of several rows with equal id and text, one stays; else all stay.
    All columns of ``docs`` come through unchanged.
    """
    # one non-null key, so that the join's partitioning serves the window too
    def key(i, h):
        return F.concat_ws(":", i.cast("string"), h.cast("string"))

    packed = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("r_"),
                         key(col(id_col), text_hash(text_col)).alias("key_"))
    out = packed.join(keys.select(key(F.col("k_id"), F.col("k_hash")).alias("key_")), "key_", "left_semi")
    if once:
        w = Window.partitionBy("key_").orderBy(F.lit(0))
        out = out.withColumn("n_", F.row_number().over(w)).where("n_ = 1")
    return out.select("r_.*")


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows (reads no more than it must)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` (narrow) rows, else as it is."""
    return F.broadcast(df) if small_enough(df, max_rows) else df

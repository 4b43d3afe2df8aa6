"""Session construction and shared-folder helpers.

Lineage is cut with ``DataFrame.checkpoint()`` or written tables under the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting names a
shared file system; we only fill it in when it is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "sparktab",
              shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sparktab-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """A path of Hadoop's file systems (the class by its name: looking packages up one by one takes a second)."""
    from py4j.java_gateway import JavaClass

    return JavaClass("org.apache.hadoop.fs.Path", spark.sparkContext._gateway._gateway_client)(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing will read again."""
    file_system(spark, path).delete(hadoop_path(spark, path), True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (stream sinks, manifests)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_sparktab_shipped", False):
        return
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="sparktab-package-"), "sparktab")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "sparktab"))  # Spark serves the file to the executors
    sc._sparktab_shipped = True


def local_table(spark: SparkSession, rows, schema):
    """A small driver-side table as a JVM ``LocalTableScan`` (Arrow path, no Python workers).

    Only for bounded inputs (fitted statistics, cut tables, ledger rows).
    """
    import pandas as pd
    from pyspark.sql import types as T

    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = [f.name for f in st.fields]
    pdf = pd.DataFrame([tuple(r) for r in rows], columns=names, dtype=object)
    if len(pdf) == 0:
        return spark.createDataFrame([], st)
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")  # Arrow path -> LocalRelation; restored right after
    try:
        return spark.createDataFrame(pdf, st)
    finally:
        spark.conf.set(key, before)


def spread(df):
    """Spread a scan that yields fewer splits than the cluster has cores.

    A small single-row-group file is read by one task, so CPU-heavy stages
    (hashing, partial aggregation, Gram sums) would use one core.  Below the
    core count we round-robin repartition once: no key (so a hot value cannot
    skew it), and Catalyst still prunes columns and pushes filters below it
    into the scan (a non-deterministic hash key, e.g. on a row id, would block
    the filter pushdown).  Spark sorts before a round-robin exchange, so the
    assignment is deterministic under task retries.
    Off unless the session sets ``sparktab.spread`` (tests and the bench do, whose
    files have one row group): on a cluster it would shuffle every table with fewer
    splits than cores in full.
    """
    if df.sparkSession.conf.get("sparktab.spread", "false") != "true":
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (glob allowed), from file-system metadata only."""
    p, fs = hadoop_path(spark, path), file_system(spark, path)
    statuses = fs.globStatus(p) or []
    return int(sum(fs.getContentSummary(st.getPath()).getLength() for st in statuses))


def tune_for_input(spark: SparkSession, total_bytes: int, partition_bytes: int = 256 << 20,
                   max_partitions: int = 200_000) -> int:
    """Spill-aware shuffle sizing: one shuffle partition per ``partition_bytes`` of input.

    Sets ``spark.sql.shuffle.partitions`` (never below the core count) and AQE's
    advisory partition size, so AQE can coalesce small partitions and split
    skewed ones around the same target.  Opt-in: call it before building a job.
    """
    cores = spark.sparkContext.defaultParallelism
    n = max(cores, min(max_partitions, -(-total_bytes // partition_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return n

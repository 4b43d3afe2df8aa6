"""A stream of scoring requests (X1, S11, C3, C4): every micro-batch is joined with the run ledger and written once.

A micro-batch is scored by ``score_requests`` (imputation, routing by run, errors as
rows) and written in one pass into ``<sink>/batch=<id>/side=scored|rejects``; a row of counts in
``<sink>_log/batch=<id>`` follows and completes it.  All of it is overwritten by batch id, so a batch that
runs again after a crash replaces what it had written, and readers count complete batches only.
The ledger is read anew in each batch, so a run that has finished meanwhile is used.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import Ledger
from ..operators.model_tables import score_requests
from ..session import scratch_path
from .scoring import read_stream


def score_batch(batch: DataFrame, batch_id: int, ledger: Ledger, sink: str, run_col: str | None, keep: Sequence[str],
                prepare: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Score one micro-batch and write it, replacing whatever the same batch wrote before."""
    batch = prepare(batch) if prepare else batch
    latest = ledger.latest_run("training")
    default = F.lit(latest["run_id"] if latest is not None else None).cast("string")
    run = F.coalesce(F.col(run_col), default) if run_col else default
    out = score_requests(batch, run, ledger, keep).withColumn(
        "side", F.when(F.col("status") == "ok", F.lit("scored")).otherwise(F.lit("rejects")))
    path = f"{sink}/batch={batch_id}"
    out.write.mode("overwrite").partitionBy("side").parquet(path)
    spark = ledger.spark
    written = spark.read.schema(out.schema).parquet(path)
    counts = written.agg(F.count(F.when(F.col("side") == "scored", 1)).alias("scored"),
                         F.count(F.when(F.col("side") == "rejects", 1)).alias("rejects"), F.current_timestamp().alias("ts"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{sink}_log/batch={batch_id}")


def score_request_stream(spark: SparkSession, ledger_root: str, source: str, schema, run_col: str | None = None,
                         keep: Sequence[str] = (), sink: str | None = None, checkpoint: str | None = None,
                         max_files_per_trigger: int | None = None, fmt: str = "parquet",
                         prepare: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Drain the source (``availableNow``); returns the written rows of complete batches, and the log."""
    sink = sink or scratch_path(spark, "requests-out")
    checkpoint = checkpoint or scratch_path(spark, "requests-ckpt")
    ledger = Ledger(spark, ledger_root)
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    stream = read_stream(spark, source, schema, fmt, **options)
    query = stream.writeStream.foreachBatch(
        lambda batch, i: score_batch(batch, i, ledger, sink, run_col, keep, prepare)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return read_batches(spark, sink)


def read_batches(spark: SparkSession, sink: str) -> tuple[DataFrame, DataFrame]:
    """(rows of complete batches, with ``batch`` and ``side``; log with one row per batch)."""
    log = spark.read.parquet(f"{sink}_log")
    rows = spark.read.parquet(sink)
    return rows.join(F.broadcast(log.select("batch")), "batch", "left_semi"), log

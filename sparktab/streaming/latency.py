"""Windowed service-level statistics over an event stream.

Event time is turned from ``timestamp_ntz`` (read as UTC) into ``timestamp``
because watermarks need the latter.  The aggregation runs in ``append`` mode:
a window is written once the watermark passes its end and its state is then
dropped, so state stays bounded by the open windows however long the stream
runs.  A window still open when the input is drained is not emitted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def windowed_stats(stream: DataFrame, ts: str = "ts", value: str = "value", window: str = "1 day",
                   delay: str = "1 hour", by: Sequence[str] = ("event_type",),
                   quantile: float | None = 0.95) -> DataFrame:
    at = F.col(ts)
    if isinstance(stream.schema[ts].dataType, T.TimestampNTZType):  # a wall clock, taken as UTC in any session zone
        at = F.convert_timezone(F.lit("UTC"), F.current_timezone(), at)
    ev = stream.withColumn("_et", at.cast("timestamp")).withWatermark("_et", delay)
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(value).alias("avg_value"), F.max(value).alias("max_value")]
    if quantile is not None:
        aggs.append(F.percentile_approx(value, quantile, 10_000).alias(f"p{int(quantile * 100)}_value"))
    out = ev.groupBy(F.window("_et", window).alias("w"), *by).agg(*aggs)
    return out.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by,
                      *[c for c in out.columns if c not in ("w", *by)])


def windowed_stream_to_table(spark: SparkSession, source: str, schema: T.StructType, window: str,
                             delay: str, sink: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Drain the source (``availableNow``) through ``windowed_stats`` into a Parquet sink."""
    sink = sink or scratch_path(spark, "stream-latency-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-latency-ckpt")
    src = spark.readStream.schema(schema).parquet(source)
    q = (windowed_stats(src, window=window, delay=delay).writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)

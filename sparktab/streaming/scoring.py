"""Streaming scoring (X1): the batch model applied to a file stream.

The same ``LinearModel.predict_col`` expression scores batch tables and
streams, so offline/online parity is an equality test.  The sink is a
Parquet folder with a checkpoint under the shared checkpoint root; the file
sink's commit log makes the output exactly-once across restarts and lost
executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.features import FeatureModel
from ..operators.models import PRED, LinearModel
from ..operators.scoring import score_partial
from ..session import scratch_path


def read_stream(spark: SparkSession, source: str, schema: T.StructType | str, fmt: str = "parquet",
                **options) -> DataFrame:
    """A typed event stream from files or a Kafka topic.

    Files: ``readStream`` with the explicit schema.  Kafka (``fmt="kafka"``,
    ``source`` = topic, ``options`` = ``kafka.bootstrap.servers`` ...): the
    record ``value`` is JSON parsed with the same schema.  The Kafka connector
    is not bundled; without it a clear error is raised.
    """
    if fmt != "kafka":
        return spark.readStream.schema(schema).options(**options).format(fmt).load(source)
    from pyspark.sql import functions as F

    try:
        raw = spark.readStream.format("kafka").option("subscribe", source).options(**options).load()
    except Exception as e:  # noqa: BLE001
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector on the classpath") from e
        raise
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("r")).select("r.*")


def score_stream(stream: DataFrame, model: LinearModel, keep: Sequence[str] = (),
                 features: FeatureModel | None = None) -> DataFrame:
    """Score a (streaming or batch) DataFrame.

    With ``features`` the partial-record path runs (C3): missing fields are
    imputed from the training statistics and reported in ``imputed``.
    """
    if features is not None:
        return score_partial(stream, features, model, keep=keep)
    return stream.select(*keep, model.predict_col(stream).alias(PRED))


def score_stream_to_table(spark: SparkSession, source: str, schema: T.StructType, model: LinearModel,
                          keep: Sequence[str] = (), sink: str | None = None,
                          checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                          features: FeatureModel | None = None, fmt: str = "parquet") -> DataFrame:
    """Drain every available file through the model (``availableNow``) and return the sink table."""
    sink = sink or scratch_path(spark, "stream-score-out")
    checkpoint = checkpoint or scratch_path(spark, "stream-score-ckpt")
    opts = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    src = read_stream(spark, source, schema, fmt, **opts)
    q = (score_stream(src, model, keep, features).writeStream.format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(sink)

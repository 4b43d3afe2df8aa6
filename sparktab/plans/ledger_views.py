"""Views that read the driver's ``events`` table as a run ledger.

``events`` becomes ``runs`` (event = run, ``event_type`` = stage, ``ts`` =
start, ``user_id`` = parent workflow) and ``metrics`` (``user_id`` = run,
``event_type`` = metric key, ``value``, ``ts``, ``event_id`` as step).  This is
how the ledger operators are exercised at table scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def runs_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("event_id").alias("run_id"), F.col("user_id").alias("parent_id"),
                         F.col("event_type").alias("stage"), F.lit("FINISHED").alias("status"),
                         F.col("ts").alias("start_ts"))


def metrics_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").alias("run_id"), F.col("event_type").alias("key"),
                         F.col("value"), F.col("ts"), F.col("event_id").alias("step"))

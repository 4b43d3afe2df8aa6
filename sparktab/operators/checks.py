"""Data validation (X5): rule rows compiled into one aggregate of conditional counts.

A rule is ``(name, kind, column, arg)`` with kinds ``not_null``, ``range``
(``arg=(lo, hi)``, inclusive; nulls are not checked), ``allowed`` (``arg`` =
values), ``regex`` (``arg`` = pattern, full-row ``rlike``) and ``unique``.
Result: ``(rule, checked, failed)``; ``quarantine`` returns the failing rows;
``validate`` writes them and counts in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import local_table, scratch_path

MAX_BROADCAST_KEYS = 1_000_000  # so many repeated values are broadcast; more are joined


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str
    column: str
    arg: Any = None


def _fails(r: Rule) -> Column:
    c = F.col(r.column)
    if r.kind == "not_null":
        return c.isNull()
    if r.kind == "range":
        lo, hi = r.arg
        return c.isNotNull() & ((c < F.lit(lo)) | (c > F.lit(hi)))
    if r.kind == "allowed":
        return c.isNotNull() & ~c.isin(list(r.arg))
    if r.kind == "regex":
        return c.isNotNull() & ~c.rlike(r.arg)
    raise ValueError(f"unknown rule kind {r.kind}")


def _checked(r: Rule) -> Column:
    return F.count(F.lit(1)) if r.kind == "not_null" else F.count(F.col(r.column))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One pass for all row rules (plus one distinct count per ``unique`` rule)."""
    row_rules = [r for r in rules if r.kind != "unique"]
    parts = []
    if row_rules:
        wide = df.agg(F.array(*[F.struct(F.lit(r.name).alias("rule"), _checked(r).alias("checked"),
                                         F.count(F.when(_fails(r), 1)).alias("failed"))
                                for r in row_rules]).alias("s"))
        parts.append(wide.select(F.inline("s")))
    for r in rules:
        if r.kind == "unique":
            # rows whose key value occurs more than once
            dup = (df.where(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count(F.lit(1)).alias("_n"))
                   .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("checked"),
                        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("failed")))
            parts.append(dup.select(F.lit(r.name).alias("rule"), F.col("checked").cast("bigint"),
                                    F.col("failed").cast("bigint")))
    if not parts:
        return df.sparkSession.createDataFrame([], "rule string, checked bigint, failed bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows failing any rule, with the failed rule names (``unique``: all rows of a repeated value)."""
    flags = []
    for i, r in enumerate(rules):
        if r.kind == "unique":  # the repeated values, joined back to their rows
            again = (df.where(F.col(r.column).isNotNull()).groupBy(F.col(r.column).alias(f"_u{i}"))
                     .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(f"_u{i}"))
            df = df.join(again, F.col(r.column) == F.col(f"_u{i}"), "left")
            flags.append(F.when(F.col(f"_u{i}").isNotNull(), F.lit(r.name)))
        else:
            flags.append(F.when(_fails(r), F.lit(r.name)))
    failed = F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")
    out = df.withColumn("failed_rules", failed).where(F.size("failed_rules") > 0)
    return out.drop(*[c for c in out.columns if c.startswith("_u")])


def validate(df: DataFrame, rules: Sequence[Rule], sink: str) -> DataFrame:
    """Write the rows that fail any rule to ``sink`` and return the rule report, from one pass over the rows.

    The counts are observed while the failing rows are written (``DataFrame.observe``), so the
    report describes exactly the rows that the quarantine was taken from.  ``unique`` takes a pass over
    its column alone first: the repeated values, written to the shared folder and joined
    with the rows (broadcast below a checked number).
    """
    spark = df.sparkSession
    if not rules or not df.head(1):  # a plan without rows is not run, and nothing would be observed
        df.limit(0).withColumn("failed_rules", F.array().cast("array<string>")).write.parquet(sink)
        return local_table(spark, [(r.name, 0, 0) for r in rules], "rule string, checked bigint, failed bigint")
    flags, counts, tagged = [], [], df
    for i, r in enumerate(rules):
        if r.kind == "unique":
            again = df.where(F.col(r.column).isNotNull()).groupBy(F.col(r.column).alias(f"_u{i}")).agg(
                F.count(F.lit(1)).alias("_n")).where("_n > 1").select(f"_u{i}")
            path = scratch_path(spark, "repeated")
            again.write.parquet(path)
            again = spark.read.schema(again.schema).parquet(path)
            if again.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS:
                again = F.broadcast(again)
            tagged = tagged.join(again, F.col(r.column) == F.col(f"_u{i}"), "left")
            fails = F.col(f"_u{i}").isNotNull()
        else:
            fails = _fails(r)
        flags.append(F.when(fails, F.lit(r.name)))
        counts += [_checked(r).alias(f"checked_{i}"), F.count(F.when(fails, 1)).alias(f"failed_{i}")]
    failed = F.array_compact(F.array(*flags))
    seen = Observation()
    tagged = tagged.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).withColumn("failed_rules", failed)
    tagged.where(F.size("failed_rules") > 0).select(*df.columns, "failed_rules").write.parquet(sink)
    got = seen.get
    return local_table(spark, [(r.name, int(got[f"checked_{i}"]), int(got[f"failed_{i}"])) for i, r in enumerate(rules)],
                       "rule string, checked bigint, failed bigint")

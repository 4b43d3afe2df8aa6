"""Table sources and sinks.

CSV: every column is read as text, NA tokens become null, and types are then
inferred with one aggregate over all columns (or taken from an explicit
schema).  This keeps type inference distributed and gives the same null rules
as the reference's CSV reader, which Spark's single ``nullValue`` cannot.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.parsing import to_double
from ..session import file_system, hadoop_path, local_table

# The text tokens the reference's CSV reader treats as missing
# (pandas read_csv defaults).
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
# Boolean spellings that make a column boolean.
TRUE_TOKENS = ["True", "TRUE", "true"]
FALSE_TOKENS = ["False", "FALSE", "false"]

_INT_MIN, _INT_MAX = -(2 ** 31), 2 ** 31 - 1


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the session's file system (also for paths without a scheme) has something at ``path``."""
    found = file_system(spark, path).globStatus(hadoop_path(spark, path))
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             dtype: Mapping[str, str] | None = None, na_tokens: Sequence[str] = NA_TOKENS,
             multi_line: bool = False) -> DataFrame:
    """Header CSV with NA-token normalisation and typed columns.

    ``schema``: explicit types (``try_cast``; a value that does not cast is null).
    ``dtype``: per-column override on top of inference.
    ``multi_line``: quoted fields may hold line breaks (a file is then one split).
    A doubled quote inside a quoted field stands for one quote.
    """
    if not _exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    raw = spark.read.csv(path, header=True, inferSchema=False, quote='"', escape='"', multiLine=multi_line)
    tokens = list(na_tokens)
    norm = raw.select(*[F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c)).alias(c)
                        for c in raw.columns])
    if schema is not None:
        st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        return norm.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in st.fields])
    types = infer_types(norm)
    if dtype:
        types.update(dtype)
    return norm.select(*[_cast(c, types[c]).alias(c) for c in norm.columns])


def _cast(c: str, t: str):
    if t == "boolean":
        return (F.when(F.col(c).isin(TRUE_TOKENS), F.lit(True))
                .when(F.col(c).isin(FALSE_TOKENS), F.lit(False)))
    if t == "string":
        return F.col(c)
    return to_double(F.col(c)) if t == "double" else F.col(c).try_cast(t)


def _typed(c, t: T.DataType):
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return to_double(c).cast(t)
    return c.try_cast(t)


def infer_types(df: DataFrame) -> dict[str, str]:
    """One aggregate decides int / bigint / double / boolean / string for every column."""
    aggs = []
    for c in df.columns:
        x = F.col(c)
        as_long = (x).try_cast("bigint")
        aggs += [
            F.count(x).alias(f"{c}__n"),
            F.count(as_long).alias(f"{c}__long"),
            F.count(to_double(x)).alias(f"{c}__dbl"),
            F.count(F.when(x.isin(TRUE_TOKENS + FALSE_TOKENS), 1)).alias(f"{c}__bool"),
            F.min(as_long).alias(f"{c}__lo"), F.max(as_long).alias(f"{c}__hi"),
        ]
    r = df.agg(*aggs).first()
    out = {}
    for c in df.columns:
        n = r[f"{c}__n"]
        if n == 0:
            out[c] = "double"  # all-null column: numeric with no values
        elif r[f"{c}__bool"] == n:
            out[c] = "boolean"
        elif r[f"{c}__long"] == n:
            lo, hi = r[f"{c}__lo"], r[f"{c}__hi"]
            out[c] = "int" if _INT_MIN <= lo and hi <= _INT_MAX else "bigint"
        elif r[f"{c}__dbl"] == n:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **opts) -> DataFrame:
    """Parquet / CSV / JSON by extension or ``fmt``."""
    fmt = fmt or os.path.splitext(path.rstrip("/"))[1].lstrip(".") or "parquet"
    if fmt == "csv":
        return read_csv(spark, path, **opts)
    try:
        return spark.read.format(fmt).options(**opts).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise


def read_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 whole_files: bool = False) -> DataFrame:
    """JSON feature records, one object per line; with ``whole_files``, one object (over any
    number of lines) or one array of objects per file.

    Without a schema each object becomes ``features: map<string,string>`` so that
    partial records can be aligned (P5) or imputed (T8); text that is not such an
    object becomes a null map, which P5 rejects as malformed.
    """
    if schema is not None:
        return spark.read.schema(schema).option("multiLine", whole_files).json(path)
    text = spark.read.text(path, wholetext=whole_files)
    if not whole_files:
        return text.where(F.length(F.trim("value")) > 0).select(
            F.from_json("value", "map<string,string>").alias("features"))
    one = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<map<string,string>>")).otherwise(
        F.array(F.from_json("value", "map<string,string>")))
    return text.select(F.explode(F.coalesce(one, F.array(F.lit(None).cast("map<string,string>")))).alias("features"))


# --- sinks ---------------------------------------------------------------

def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a result table (predictions, rejects, scored rows)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_small_json(spark: SparkSession, payload: str, path: str) -> None:
    """One small JSON document (statistics, metadata, metrics) as a one-row table."""
    local_table(spark, [(payload,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_small_json(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()["value"]

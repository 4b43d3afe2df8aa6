"""Registered queries over the driver's tables, each with an equivalent DuckDB SQL oracle.

Every query reads whole tables.  Conventions shared by both sides:

* doubles leave the query rounded to float precision (``cast as float`` then
  back to ``double``), so engine-specific summation order cannot change the
  value; counts are ``bigint``;
* the train/test split is the portable md5 hash split (seed 42, test share 0.2);
* every output column is aliased identically in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_u32, sql_hash_u32, threshold
from ..operators import checks, drift, profile, stats
from ..operators.features import dummies, dummy_levels, fit_features, impute, imputed_map
from ..operators.metrics import regression_metrics, rmsle
from ..operators.models import LinearModel, fit_gbt, fit_linear, predict_tree
from ..operators.search import random_search, ridge_search
from ..operators.roles import Roles, infer_roles
from ..operators.model_tables import score_by_table
from ..operators.split import TEST, TRAIN, hash_split, stratified_split
from ..session import local_table, spread
from . import ledger_views

SEED, TEST_SHARE = 42, 0.2
LKEYS = ["l_orderkey", "l_linenumber"]
LNUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUT = threshold(TEST_SHARE)
NULL_SHARE = threshold(0.05)
DRIFT_CUT = "1998-06-01"  # reference period: shipments before this date

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{d}/{name}.parquet"))


def r(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("float").cast("double")


def sr(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


L_HASH = sql_hash_u32(LKEYS, SEED)
L_TEST = f"{L_HASH} < {CUT}"
L_TRAIN = f"{L_HASH} >= {CUT}"


def _lineitem_split(spark, d) -> DataFrame:
    return hash_split(t(spark, d, "lineitem"), LKEYS, TEST_SHARE, SEED)


# --- L1 / L2 -----------------------------------------------------------------

@register("split_counts", f"""
SELECT CASE WHEN {L_TEST} THEN 'test' ELSE 'train' END AS split,
       count(*) AS n_rows, {sr('avg(l_extendedprice)')} AS avg_price
FROM lineitem GROUP BY 1""")
def split_counts(spark, d):
    return (_lineitem_split(spark, d).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), r(F.avg("l_extendedprice")).alias("avg_price")))


@register("split_stratified", f"""
WITH h AS (SELECT l_returnflag, {L_HASH} AS h FROM lineitem),
r AS (SELECT l_returnflag, h, row_number() OVER (PARTITION BY l_returnflag ORDER BY h) AS rn,
             count(*) OVER (PARTITION BY l_returnflag) AS n FROM h),
cut AS (SELECT l_returnflag, h AS cut FROM r WHERE rn = CAST(ceil(n * CAST({TEST_SHARE} AS DOUBLE)) AS BIGINT))
SELECT h.l_returnflag, CASE WHEN h.h <= cut.cut THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows
FROM h JOIN cut USING (l_returnflag) GROUP BY 1, 2""")
def split_stratified(spark, d):
    s = stratified_split(t(spark, d, "lineitem"), LKEYS, "l_returnflag", TEST_SHARE, SEED)
    return s.groupBy("l_returnflag", "split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("split_exact", f"""
WITH h AS (SELECT {L_HASH} AS h FROM lineitem),
r AS (SELECT h, row_number() OVER (ORDER BY h) AS rn, count(*) OVER () AS n FROM h),
cut AS (SELECT h AS cut FROM r WHERE rn = CAST(ceil(n * CAST({TEST_SHARE} AS DOUBLE)) AS BIGINT))
SELECT CASE WHEN h.h <= cut.cut THEN 'test' ELSE 'train' END AS split, count(*) AS n_rows
FROM h, cut GROUP BY 1""")
def split_exact(spark, d):
    from ..operators.split import exact_split
    s = exact_split(t(spark, d, "lineitem"), LKEYS, TEST_SHARE, SEED)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


# --- R3-R14 --------------------------------------------------------------------

@register("dataset_summary", """
SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns,
       round((count(*) * 32 + sum(strlen(o_orderstatus)) + sum(strlen(o_orderpriority))) / 1048576.0, 3) AS memory_mb
FROM orders""")
def dataset_summary(spark, d):
    return profile.dataset_summary(t(spark, d, "orders"))


_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("null_counts", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM orders"
    for c in _ORDERS_COLS))
def null_counts(spark, d):
    return profile.null_counts(t(spark, d, "orders"))


# The Spark type names of the orders columns, as the schema reports them.
_ORDERS_TYPES = [('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'), ('o_orderdate', 'timestamp_ntz'), ('o_orderpriority', 'string')]


@register("info", "\nUNION ALL\n".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null FROM orders"
    for i, (c, t) in enumerate(_ORDERS_TYPES)))
def info(spark, d):
    return profile.info(t(spark, d, "orders"))


@register("head", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, {sr('o_totalprice')} AS o_totalprice, o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 5""")
def head(spark, d):
    o = t(spark, d, "orders")
    return profile.head(o, 5, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", r("o_totalprice").alias("o_totalprice"), "o_orderpriority")


@register("describe", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, count({c}) AS count, {sr(f'avg({c})')} AS mean, {sr(f'stddev_samp({c})')} AS std,
       {sr(f'min({c})')} AS min, {sr(f'quantile_cont({c}, 0.25)')} AS q25, {sr(f'quantile_cont({c}, 0.5)')} AS q50,
       {sr(f'quantile_cont({c}, 0.75)')} AS q75, {sr(f'max({c})')} AS max FROM lineitem""" for c in LNUM))
def describe(spark, d):
    df = profile.describe(t(spark, d, "lineitem"), LNUM)
    return df.select("feature", "count", *[r(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("describe_bracket", ORACLE["describe"])
def describe_bracket(spark, d):
    """R8 through the at-scale quartile path (sketch brackets), forced on the test tables."""
    df = profile.describe(t(spark, d, "lineitem"), LNUM, exact="bracket")
    return df.select("feature", "count", *[r(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("value_counts", "SELECT p_type AS level, count(*) AS n FROM part GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(t(spark, d, "part"), "p_type")


def _sql_bin(v: str, lo: str, hi: str, bins: int) -> str:
    return f"least(CAST(floor(({v} - {lo}) / ({hi} - {lo}) * {bins}) AS BIGINT), {bins - 1})"


@register("histogram", f"""
WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT {_sql_bin('l_extendedprice', 'lo', 'hi', 20)} AS bin,
       {sr(f"any_value(lo) + {_sql_bin('l_extendedprice', 'lo', 'hi', 20)} * ((any_value(hi) - any_value(lo)) / CAST(20 AS DOUBLE))")} AS lo,
       {sr(f"any_value(lo) + ({_sql_bin('l_extendedprice', 'lo', 'hi', 20)} + 1) * ((any_value(hi) - any_value(lo)) / CAST(20 AS DOUBLE))")} AS hi,
       count(*) AS n
FROM lineitem, s GROUP BY 1""")
def histogram(spark, d):
    h = profile.histogram(t(spark, d, "lineitem"), "l_extendedprice", 20)
    return h.select("bin", r("lo").alias("lo"), r("hi").alias("hi"), "n")


@register("pair_bins", f"""
WITH s AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl,
                  max(l_extendedprice) AS yh FROM lineitem)
SELECT {_sql_bin('l_quantity', 'xl', 'xh', 10)} AS bx, {_sql_bin('l_extendedprice', 'yl', 'yh', 10)} AS by,
       count(*) AS n
FROM lineitem, s GROUP BY 1, 2""")
def pair_bins(spark, d):
    return profile.pair_bins(t(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 10)


@register("density", f"""
WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, count(l_quantity) AS n,
                  stddev_samp(l_quantity) AS sd FROM lineitem),
p AS (SELECT lo, hi, n, sd * pow(n, -0.2) AS h, (hi - lo) / CAST(50 AS DOUBLE) AS w,
             (hi - lo) / CAST(199 AS DOUBLE) AS step FROM s),
b AS (SELECT {_sql_bin('l_quantity', 'lo', 'hi', 50)} AS b, count(*) AS c FROM lineitem, p GROUP BY 1),
g AS (SELECT range AS i FROM range(200))
SELECT CAST(i AS BIGINT) AS i, {sr('lo + i * step')} AS x,
       {sr('sum(c * exp(-0.5 * pow(((lo + i * step) - (lo + (b + 0.5) * w)) / h, 2))) * (1.0 / (n * h * sqrt(2.0 * pi())))')} AS density
FROM g, p, b GROUP BY i, lo, step, n, h""")
def density(spark, d):
    k = profile.density(t(spark, d, "lineitem"), "l_quantity", 50, 200)
    return k.select("i", r("x").alias("x"), r("density").alias("density"))


_BOX_SQL = """
WITH q AS (SELECT o_orderpriority, quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders GROUP BY 1),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
"""


@register("box_stats", _BOX_SQL + f"""
SELECT o.o_orderpriority, count(o_totalprice) AS n, {sr('any_value(q1)')} AS q1, {sr('any_value(med)')} AS median,
       {sr('any_value(q3)')} AS q3,
       {sr('min(CASE WHEN o_totalprice BETWEEN lo_f AND hi_f THEN o_totalprice END)')} AS whisker_lo,
       {sr('max(CASE WHEN o_totalprice BETWEEN lo_f AND hi_f THEN o_totalprice END)')} AS whisker_hi,
       count(CASE WHEN NOT (o_totalprice BETWEEN lo_f AND hi_f) THEN 1 END) AS n_outliers
FROM orders o JOIN f USING (o_orderpriority) GROUP BY 1""")
def box_stats(spark, d):
    s, _ = profile.box_stats(t(spark, d, "orders"), "o_totalprice", "o_orderpriority")
    return s.select("o_orderpriority", "n", *[r(c).alias(c) for c in ["q1", "median", "q3", "whisker_lo", "whisker_hi"]],
                    "n_outliers")


@register("box_outliers", _BOX_SQL + f"""
SELECT o_orderkey, o.o_orderpriority, {sr('o_totalprice')} AS o_totalprice
FROM orders o JOIN f USING (o_orderpriority) WHERE NOT (o_totalprice BETWEEN lo_f AND hi_f)""")
def box_outliers(spark, d):
    _, out = profile.box_stats(t(spark, d, "orders"), "o_totalprice", "o_orderpriority")
    return out.select("o_orderkey", "o_orderpriority", r("o_totalprice").alias("o_totalprice"))


_CORR_COLS = LNUM + ["l_returnflag_A", "l_returnflag_N", "l_returnflag_R", "l_linestatus_F", "l_linestatus_O"]


@register("correlation_long", """
WITH e AS (SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS l_returnflag_A,
  CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS l_returnflag_N,
  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS l_returnflag_R,
  CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS l_linestatus_F,
  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS l_linestatus_O FROM lineitem)
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {sr(f'corr({a}, {b})')} AS r FROM e"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]))
def correlation_long(spark, d):
    li = t(spark, d, "lineitem").select(*LNUM, "l_returnflag", "l_linestatus")
    cats = ["l_returnflag", "l_linestatus"]
    enc = dummies(li, cats, dummy_levels(li, cats))
    cols = LNUM + [c for c in enc.columns if c.startswith("l_returnflag_") or c.startswith("l_linestatus_")]
    return profile.correlation_long(enc, cols).select("a", "b", r("r").alias("r"))


# --- A1-A3, A6, R2 ---------------------------------------------------------------

@register("numeric_stats", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, count({c}) AS n, {sr(f'avg({c})')} AS mean, {sr(f'stddev_samp({c})')} AS std,
       {sr(f'stddev_pop({c})')} AS std_pop, {sr(f'min({c})')} AS min, {sr(f'max({c})')} AS max
FROM lineitem WHERE {L_TRAIN}""" for c in LNUM))
def numeric_stats(spark, d):
    tr = _lineitem_split(spark, d).where(F.col("split") == TRAIN)
    s = stats.numeric_stats(tr, LNUM)
    return s.select("feature", "n", *[r(c).alias(c) for c in ["mean", "std", "std_pop", "min", "max"]])


@register("level_counts", f"""
SELECT 'l_returnflag' AS feature, l_returnflag AS level, count(*) AS n FROM lineitem WHERE {L_TRAIN} GROUP BY 2
UNION ALL
SELECT 'l_linestatus' AS feature, l_linestatus AS level, count(*) AS n FROM lineitem WHERE {L_TRAIN} GROUP BY 2""")
def level_counts(spark, d):
    tr = _lineitem_split(spark, d).where(F.col("split") == TRAIN)
    return stats.level_counts(tr, ["l_returnflag", "l_linestatus"])


@register("mode_levels", """
WITH c AS (SELECT 'o_orderstatus' AS feature, o_orderstatus AS level, count(*) AS n FROM orders GROUP BY 2
           UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, level DESC) AS rn FROM c)
SELECT feature, level AS mode, n FROM r WHERE rn = 1""")
def mode_levels(spark, d):
    c = stats.level_counts(t(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])
    return stats.mode_levels(c)


_L_ROLES_EXCLUDE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


@register("feature_names", f"""
WITH lv AS (SELECT DISTINCT 1 AS fo, 'l_returnflag' AS f, l_returnflag AS level FROM lineitem WHERE {L_TRAIN}
            UNION ALL SELECT DISTINCT 2, 'l_linestatus', l_linestatus FROM lineitem WHERE {L_TRAIN})
SELECT CAST(0 AS BIGINT) AS pos, 'numeric__l_quantity' AS name
UNION ALL SELECT 1, 'numeric__l_discount' UNION ALL SELECT 2, 'numeric__l_tax'
UNION ALL SELECT CAST(2 + row_number() OVER (ORDER BY fo, level) AS BIGINT), 'categorical__' || f || '_' || level FROM lv""")
def feature_names(spark, d):
    li = _lineitem_split(spark, d)
    roles = infer_roles(li.drop("split"), exclude=_L_ROLES_EXCLUDE)
    fm = fit_features(li.where(F.col("split") == TRAIN), roles)
    names = fm.feature_names
    return local_table(spark, list(enumerate(names)), "pos bigint, name string")


# --- T1, T2, T5, T7, T8 ------------------------------------------------------------

_ZNUM = ["l_quantity", "l_discount", "l_tax"]


@register("standardise", f"""
WITH s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _ZNUM)}
           FROM lineitem WHERE {L_TRAIN})
SELECT l_orderkey, l_linenumber,
  {', '.join(sr(f'({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END') + f' AS z_{c}' for c in _ZNUM)}
FROM lineitem, s""")
def standardise(spark, d):
    li = _lineitem_split(spark, d)
    fm = fit_features(li.where(F.col("split") == TRAIN), Roles(_ZNUM, []))
    return li.select(*LKEYS, *[r(fm.standardized(c)).alias(f"z_{c}") for c in _ZNUM])


@register("one_hot", """
SELECT l_orderkey, l_linenumber,
  CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS DOUBLE) AS "categorical__l_returnflag_A",
  CAST(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS DOUBLE) AS "categorical__l_returnflag_N",
  CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS DOUBLE) AS "categorical__l_returnflag_R",
  CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS DOUBLE) AS "categorical__l_linestatus_F",
  CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS DOUBLE) AS "categorical__l_linestatus_O"
FROM lineitem""")
def one_hot(spark, d):
    li = _lineitem_split(spark, d)
    fm = fit_features(li.where(F.col("split") == TRAIN), Roles([], ["l_returnflag", "l_linestatus"]))
    return li.select(*LKEYS, *fm.one_hot("l_returnflag", li), *fm.one_hot("l_linestatus", li))


@register("dummies", """
SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS c_acctbal,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 1 ELSE 0 END AS c_mktsegment_AUTOMOBILE,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS c_mktsegment_BUILDING,
  CASE WHEN c_mktsegment = 'FURNITURE' THEN 1 ELSE 0 END AS c_mktsegment_FURNITURE,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS c_mktsegment_HOUSEHOLD,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END AS c_mktsegment_MACHINERY
FROM customer""")
def dummies_q(spark, d):
    c = t(spark, d, "customer")
    out = dummies(c, ["c_mktsegment"], dummy_levels(c, ["c_mktsegment"]))
    return out.withColumn("c_acctbal", r("c_acctbal"))


def _orders_with_gaps(spark, d) -> DataFrame:
    """orders with missing values: 5% of prices and of priorities (hash-chosen)."""
    o = t(spark, d, "orders")
    return hash_split(o.select(
        "o_orderkey",
        F.when(hash_u32(["o_orderkey"], 7) < NULL_SHARE, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(hash_u32(["o_orderkey"], 11) < NULL_SHARE, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    ), ["o_orderkey"], TEST_SHARE, SEED)


_GAPS_SQL = f"""
WITH o AS (SELECT o_orderkey,
    CASE WHEN {sql_hash_u32(['o_orderkey'], 7)} < {NULL_SHARE} THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN {sql_hash_u32(['o_orderkey'], 11)} < {NULL_SHARE} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
    {sql_hash_u32(['o_orderkey'], SEED)} AS h FROM orders),
tr AS (SELECT * FROM o WHERE h >= {CUT}),
m AS (SELECT avg(o_totalprice) AS mu FROM tr),
lc AS (SELECT coalesce(o_orderpriority, 'nan') AS level, count(*) AS n FROM tr GROUP BY 1),
md AS (SELECT level AS mode FROM lc ORDER BY n DESC, level DESC LIMIT 1)
"""


def _gaps_model(spark, d):
    o = _orders_with_gaps(spark, d)
    fm = fit_features(o.where(F.col("split") == TRAIN), Roles(["o_totalprice"], ["o_orderpriority"]))
    return o, fm


@register("impute", _GAPS_SQL + f"""
SELECT o_orderkey, {sr('coalesce(o_totalprice, mu)')} AS o_totalprice, coalesce(o_orderpriority, mode) AS o_orderpriority
FROM o, m, md""")
def impute_q(spark, d):
    o, fm = _gaps_model(spark, d)
    return impute(o, fm).select("o_orderkey", r("o_totalprice").alias("o_totalprice"), "o_orderpriority")


@register("imputed_map", _GAPS_SQL + """
SELECT o_orderkey,
  CAST((o_totalprice IS NULL)::INT + (o_orderpriority IS NULL)::INT AS BIGINT) AS n_imputed,
  concat_ws(';', CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority=' || mode END,
                 CASE WHEN o_totalprice IS NULL THEN 'o_totalprice=' || CAST(CAST(mu AS DECIMAL(38, 6)) AS VARCHAR) END) AS imputed
FROM o, m, md""")
def imputed_map_q(spark, d):
    o, fm = _gaps_model(spark, d)
    m = imputed_map(fm)
    # the operator keeps all digits of a mean; six decimals are compared
    value = lambda e: F.when(e["key"] == "o_totalprice", e["value"].try_cast("decimal(38,6)").cast("string")).otherwise(
        e["value"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries(m)),
                                    lambda e: F.concat(e["key"], F.lit("="), value(e))), ";")
    return o.select("o_orderkey", F.size(m).cast("bigint").alias("n_imputed"), text.alias("imputed"))


@register("score_partial", _GAPS_SQL + f"""
, gm AS (SELECT coalesce(o_orderpriority, 'nan') AS level, avg(o_totalprice) AS mu_g
         FROM tr WHERE o_totalprice IS NOT NULL GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderpriority IS NULL THEN 'o_orderpriority=' || mode ELSE '' END AS imputed,
       {sr('mu_g')} AS y_pred
FROM o CROSS JOIN md JOIN gm ON gm.level = coalesce(o.o_orderpriority, md.mode)""")
def score_partial_q(spark, d):
    """Price from priority, fitted on complete training rows; missing priority imputed first."""
    from ..operators.scoring import score_partial
    o = _orders_with_gaps(spark, d)
    tr = o.where(F.col("split") == TRAIN)
    fm = fit_features(tr, Roles([], ["o_orderpriority"]), target="o_totalprice")
    lm = fit_linear(tr, fm, "o_totalprice")
    out = score_partial(o.select("o_orderkey", "o_orderpriority"), fm, lm, keep=["o_orderkey"])
    text = F.array_join(F.transform(F.array_sort(F.map_entries("imputed")),
                                    lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return out.select("o_orderkey", text.alias("imputed"), r("y_pred").alias("y_pred"))


# --- P5 / C2 ---------------------------------------------------------------------------

@register("strict_rejects", """
SELECT event_id,
  CASE WHEN json_exists(props, '$.k') AND event_type = 'purchase' THEN 'ok' ELSE 'rejected' END AS status,
  concat_ws(',', CASE WHEN NOT json_exists(props, '$.k') THEN 'k' END,
                 CASE WHEN event_type <> 'purchase' THEN 'value' END) AS missing,
  CASE WHEN json_exists(props, '$.k') AND event_type = 'purchase'
       THEN CAST(CAST(json_extract_string(props, '$.k') AS DOUBLE) AS FLOAT)::DOUBLE END AS k
FROM events""")
def strict_rejects(spark, d):
    """events' JSON props as feature records; one projection tags accepted / rejected."""
    from ..operators.features import tag_records
    e = t(spark, d, "events")
    rec = F.from_json("props", "map<string,string>")
    # purchases carry their value as a feature; other events do not
    rec = F.when(F.col("event_type") == "purchase",
                 F.map_concat(rec, F.create_map(F.lit("value"), F.col("value").cast("string")))).otherwise(rec)
    tagged = tag_records(e.select("event_id", rec.alias("features")), "features", ["k", "value"], [])
    ok = F.col("status") == "ok"
    return tagged.select("event_id", "status",
                         F.array_join(F.array_union("missing", "bad_cast"), ",").alias("missing"),
                         F.when(ok, r("k")).alias("k"))


# --- M1 / A4 / A5 / A7 -------------------------------------------------------------------

def _group_slope_model(spark, d) -> tuple[DataFrame, LinearModel]:
    li = _lineitem_split(spark, d)
    tr = li.where(F.col("split") == TRAIN)
    fm = fit_features(tr, Roles(["l_quantity"], ["l_returnflag"]), target="l_extendedprice")
    return li, fit_linear(tr, fm, "l_extendedprice")


def _group_intercepts(m: LinearModel) -> tuple[float, dict[str, float]]:
    (_, mean, scale, w), = m.numeric
    slope = w / scale
    base = m.intercept - w * mean / scale
    return slope, {lv: base + wl for lv, wl in m.categorical[0][1]}


_GS_SQL = f"""
WITH tr AS (SELECT l_returnflag AS g, l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE {L_TRAIN}),
gm AS (SELECT g, avg(x) AS mx, avg(y) AS my FROM tr GROUP BY g),
sl AS (SELECT sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS slope FROM tr JOIN gm USING (g)),
co AS (SELECT g, my - slope * mx AS a FROM gm, sl),
te AS (SELECT l_returnflag AS g, l_linestatus, l_quantity AS x, l_extendedprice AS y_true FROM lineitem WHERE {L_TEST}),
pr AS (SELECT te.*, a + slope * x AS y_pred FROM te JOIN co USING (g), sl)
"""


@register("ols_one_feature", f"""
SELECT {sr('regr_slope(l_extendedprice, l_quantity)')} AS slope,
       {sr('regr_intercept(l_extendedprice, l_quantity)')} AS intercept, count(*) AS n_train
FROM lineitem WHERE {L_TRAIN}""")
def ols_one_feature(spark, d):
    li = _lineitem_split(spark, d)
    tr = li.where(F.col("split") == TRAIN)
    fm = fit_features(tr, Roles(["l_quantity"], []), target="l_extendedprice")
    m = fit_linear(tr, fm, "l_extendedprice")
    (_, mean, scale, w), = m.numeric
    return local_table(spark, [(w / scale, m.intercept - w * mean / scale, fm.n_rows)],
                                 "slope double, intercept double, n_train bigint") \
        .select(r("slope").alias("slope"), r("intercept").alias("intercept"), "n_train")


@register("ols_group_slope", _GS_SQL + f"""
SELECT 'slope' AS term, {sr('slope')} AS value FROM sl
UNION ALL SELECT 'intercept_' || g, {sr('a')} FROM co""")
def ols_group_slope(spark, d):
    _, m = _group_slope_model(spark, d)
    slope, a = _group_intercepts(m)
    rows = [("slope", slope)] + [(f"intercept_{g}", v) for g, v in a.items()]
    return local_table(spark, rows, "term string, value double").select("term", r("value").alias("value"))


@register("ols_group_slope_ml", ORACLE["ols_group_slope"])
def ols_group_slope_ml(spark, d):
    """M1 through Spark ML's normal-equation solver on a reference-coded design (re-centred)."""
    from ..operators.models import fit_linear_ml
    li = _lineitem_split(spark, d)
    tr = li.where(F.col("split") == TRAIN)
    fm = fit_features(tr, Roles(["l_quantity"], ["l_returnflag"]), target="l_extendedprice")
    slope, a = _group_intercepts(fit_linear_ml(tr, fm, "l_extendedprice"))
    rows = [("slope", slope)] + [(f"intercept_{g}", v) for g, v in a.items()]
    return local_table(spark, rows, "term string, value double").select("term", r("value").alias("value"))


_METRIC_SQL = f"""count(*) AS n, {sr('avg(abs(y_true - y_pred))')} AS mae, {sr('avg((y_true - y_pred) * (y_true - y_pred))')} AS mse,
  {sr('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))')} AS rmse,
  {sr('CASE WHEN count(*) < 2 THEN NULL WHEN var_pop(y_true) = 0 THEN CASE WHEN sum((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) END')} AS r2"""


def _holdout_preds(spark, d) -> DataFrame:
    li, m = _group_slope_model(spark, d)
    te = li.where(F.col("split") == TEST)
    return te.select("l_linestatus", F.col("l_extendedprice").alias("y_true"), m.predict_col(te).alias("y_pred"))


def _round_metrics(df: DataFrame, keys=()) -> DataFrame:
    return df.select(*keys, "n", *[r(c).alias(c) for c in ["mae", "mse", "rmse", "r2"]])


@register("holdout_metrics", _GS_SQL + f"SELECT {_METRIC_SQL} FROM pr")
def holdout_metrics(spark, d):
    return _round_metrics(regression_metrics(_holdout_preds(spark, d)))


@register("metrics_by_slice", _GS_SQL + f"SELECT l_linestatus, {_METRIC_SQL} FROM pr GROUP BY 1")
def metrics_by_slice(spark, d):
    return _round_metrics(regression_metrics(_holdout_preds(spark, d), by=["l_linestatus"]), ["l_linestatus"])


@register("rmsle", _GS_SQL + f"""
SELECT count(*) AS n, CAST(sum(CASE WHEN y_true < 0 OR y_pred < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative,
  {sr('CASE WHEN sum(CASE WHEN y_true < 0 OR y_pred < 0 THEN 1 ELSE 0 END) > 0 THEN NULL ELSE sqrt(avg((ln(1 + y_true) - ln(1 + y_pred)) * (ln(1 + y_true) - ln(1 + y_pred)))) END')} AS rmsle
FROM pr""")
def rmsle_q(spark, d):
    out = rmsle(_holdout_preds(spark, d))
    return out.select("n", "n_negative", r("rmsle").alias("rmsle"))


@register("compare_runs", _GS_SQL + f"""
, one AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a
          FROM lineitem WHERE {L_TRAIN}),
both_runs AS (SELECT 'group_slope' AS run_id, y_true, y_pred FROM pr
              UNION ALL SELECT 'one_feature', y_true, a + b * x FROM te, one)
SELECT run_id, {_METRIC_SQL} FROM both_runs GROUP BY 1""")
def compare_runs_q(spark, d):
    """Two candidate runs (nested feature sets) fitted from one Gram pass, scored in one scan."""
    from ..operators.models import fit_linear_nested
    from ..operators.scoring import compare_runs
    li = _lineitem_split(spark, d)
    tr = li.where(F.col("split") == TRAIN)
    fm = fit_features(tr, Roles(["l_quantity"], ["l_returnflag"]), target="l_extendedprice")
    runs = fit_linear_nested(tr, fm, "l_extendedprice", {"group_slope": (["l_quantity"], ["l_returnflag"]),
                                                          "one_feature": (["l_quantity"], [])})
    out = compare_runs(li.where(F.col("split") == TEST), "l_extendedprice", runs)
    return _round_metrics(out, ["run_id"])


# --- G1 / G7 / G8: events read as a run ledger ----------------------------------------------

@register("latest_by_stage", """
WITH r AS (SELECT event_type AS stage, event_id AS run_id, user_id AS parent_id,
                  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT stage, run_id, parent_id FROM r WHERE rn = 1""")
def latest_by_stage(spark, d):
    runs = ledger_views.runs_from_events(t(spark, d, "events"))
    from ..operators.ledger import latest_by_stage as g1
    return g1(runs).select("stage", "run_id", "parent_id")


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register("run_compare", """
WITH l AS (SELECT user_id, event_type, value,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id AS run_id, """ + ", ".join(
    f"CAST(CAST(max(CASE WHEN event_type = '{k}' THEN value END) AS FLOAT) AS DOUBLE) AS {k}" for k in _EVENT_TYPES)
    + " FROM l WHERE rn = 1 GROUP BY user_id")
def run_compare(spark, d):
    from ..operators.ledger import compare_runs
    m = ledger_views.metrics_from_events(t(spark, d, "events"))
    wide = compare_runs(m)
    return wide.select("run_id", *[r(c).alias(c) for c in wide.columns if c != "run_id"])


@register("workflow_summary", """
WITH l AS (SELECT user_id, event_type, event_id,
                  row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id AS parent_id, """ + ", ".join(
    f"max(CASE WHEN event_type = '{k}' THEN event_id END) AS {k}" for k in _EVENT_TYPES)
    + " FROM l WHERE rn = 1 GROUP BY user_id")
def workflow_summary(spark, d):
    from ..operators.ledger import workflow_summary as g7
    runs = ledger_views.runs_from_events(t(spark, d, "events"))
    return g7(runs)


# --- C4 ----------------------------------------------------------------------------------------

@register("score_pinned", f"""
WITH m AS (SELECT c_mktsegment AS run_id, regr_slope(c_acctbal, c_nationkey) AS b,
                  regr_intercept(c_acctbal, c_nationkey) AS a
           FROM customer WHERE {sql_hash_u32(['c_custkey'], SEED)} >= {CUT} GROUP BY 1)
SELECT c_custkey, c_mktsegment AS model_run_id, CASE WHEN m.run_id IS NULL THEN 'not_found' ELSE 'ok' END AS status,
       {sr('a + b * c_nationkey')} AS y_pred
FROM customer LEFT JOIN m ON c_mktsegment = m.run_id""")
def score_pinned_q(spark, d):
    c = hash_split(t(spark, d, "customer"), ["c_custkey"], TEST_SHARE, SEED)
    y, x = F.col("c_acctbal").cast("double"), F.col("c_nationkey").cast("double")
    models = c.where(F.col("split") == TRAIN).groupBy(F.col("c_mktsegment").alias("run_id")).agg(
        F.regr_slope(y, x).alias("c_nationkey"), F.regr_intercept(y, x).alias("intercept"))  # a table, never collected
    out = score_by_table(c.withColumnRenamed("c_mktsegment", "model_run_id"), "model_run_id", models, ["c_nationkey"])
    return out.select("c_custkey", "model_run_id", "status", r("y_pred").alias("y_pred"))


# --- X3 / X4 / X5 ----------------------------------------------------------------------------

_DRIFT_COLS = ["l_extendedprice", "l_quantity", "l_discount"]
_IS_REF_SQL = f"l_shipdate < TIMESTAMP '{DRIFT_CUT}'"
_LONG_SQL = "\nUNION ALL\n".join(
    f"SELECT {_IS_REF_SQL} AS ref, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in _DRIFT_COLS)


def _is_ref() -> Column:
    return F.col("l_shipdate") < F.lit(DRIFT_CUT).cast("timestamp_ntz")


@register("psi_drift", f"""
WITH l AS ({_LONG_SQL}),
e AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM l WHERE ref GROUP BY 1),
b AS (SELECT l.feature, ref, {' + '.join(f'CAST(value > q[{i}] AS INT)' for i in range(1, 10))} AS bin
      FROM l JOIN e USING (feature)),
c AS (SELECT feature, bin, count(*) FILTER (WHERE ref) AS n_ref, count(*) FILTER (WHERE NOT ref) AS n_cur FROM b GROUP BY 1, 2),
s AS (SELECT *, greatest(n_ref / sum(n_ref) OVER (PARTITION BY feature), 1e-6) AS p,
                greatest(n_cur / sum(n_cur) OVER (PARTITION BY feature), 1e-6) AS q FROM c)
SELECT feature, {sr('sum((q - p) * ln(q / p))')} AS psi, CAST(sum(n_ref) AS BIGINT) AS n_ref,
       CAST(sum(n_cur) AS BIGINT) AS n_cur FROM s GROUP BY 1""")
def psi_drift(spark, d):
    out = drift.psi(t(spark, d, "lineitem"), _DRIFT_COLS, _is_ref())
    return out.select("feature", r("psi").alias("psi"), F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"))


_KS_COLS = LNUM


@register("ks_drift", "WITH l AS (" + "\nUNION ALL\n".join(
    f"SELECT {_IS_REF_SQL} AS ref, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem" for c in _KS_COLS)
    + f"""),
c AS (SELECT feature, value, count(*) FILTER (WHERE ref) AS a, count(*) FILTER (WHERE NOT ref) AS b FROM l GROUP BY 1, 2),
f AS (SELECT feature,
        sum(a) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(a) OVER (PARTITION BY feature) AS fa,
        sum(b) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) / sum(b) OVER (PARTITION BY feature) AS fb,
        sum(a) OVER (PARTITION BY feature) AS na, sum(b) OVER (PARTITION BY feature) AS nb FROM c)
SELECT feature, {sr('max(abs(fa - fb))')} AS ks, CAST(any_value(na) AS BIGINT) AS n_ref,
       CAST(any_value(nb) AS BIGINT) AS n_cur FROM f GROUP BY 1""")
def ks_drift(spark, d):
    out = drift.ks(t(spark, d, "lineitem"), _KS_COLS, _is_ref())
    return out.select("feature", r("ks").alias("ks"), F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"))


@register("ks_drift_ranged", ORACLE["ks_drift"])
def ks_drift_ranged(spark, d):
    """X4 through the at-scale path (range-partitioned prefix summaries), forced on the test tables."""
    out = drift.ks(t(spark, d, "lineitem"), _KS_COLS, _is_ref(), max_distinct=0)
    return out.select("feature", r("ks").alias("ks"), F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"))


ORDER_RULES = [
    checks.Rule("orders.o_orderkey.not_null", "not_null", "o_orderkey"),
    checks.Rule("orders.o_orderkey.unique", "unique", "o_orderkey"),
    checks.Rule("orders.o_totalprice.range", "range", "o_totalprice", (1000.0, 400000.0)),
    checks.Rule("orders.o_orderstatus.allowed", "allowed", "o_orderstatus", ("F", "O", "P")),
    checks.Rule("orders.o_orderpriority.regex", "regex", "o_orderpriority", "^[1-5]-[A-Z]+$"),
]
PART_RULES = [
    checks.Rule("part.p_retailprice.not_null", "not_null", "p_retailprice"),
    checks.Rule("part.p_size.range", "range", "p_size", (1, 45)),
    checks.Rule("part.p_brand.regex", "regex", "p_brand", "^Brand#[0-9]+$"),
    checks.Rule("part.p_type.allowed", "allowed", "p_type", ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")),
]


@register("rule_report", """
SELECT 'orders.o_orderkey.not_null' AS rule, count(*) AS checked, count(*) - count(o_orderkey) AS failed FROM orders
UNION ALL SELECT 'orders.o_orderkey.unique', count(o_orderkey),
  CAST((SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1)) AS BIGINT) FROM orders
UNION ALL SELECT 'orders.o_totalprice.range', count(o_totalprice), count(*) FILTER (WHERE o_totalprice < 1000.0 OR o_totalprice > 400000.0) FROM orders
UNION ALL SELECT 'orders.o_orderstatus.allowed', count(o_orderstatus), count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O', 'P')) FROM orders
UNION ALL SELECT 'orders.o_orderpriority.regex', count(o_orderpriority), count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')) FROM orders
UNION ALL SELECT 'part.p_retailprice.not_null', count(*), count(*) - count(p_retailprice) FROM part
UNION ALL SELECT 'part.p_size.range', count(p_size), count(*) FILTER (WHERE p_size < 1 OR p_size > 45) FROM part
UNION ALL SELECT 'part.p_brand.regex', count(p_brand), count(*) FILTER (WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]+$')) FROM part
UNION ALL SELECT 'part.p_type.allowed', count(p_type), count(*) FILTER (WHERE p_type NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL')) FROM part""")
def rule_report(spark, d):
    a = checks.rule_report(t(spark, d, "orders"), ORDER_RULES)
    b = checks.rule_report(t(spark, d, "part"), PART_RULES)
    return a.unionByName(b).select("rule", F.col("checked").cast("bigint"), F.col("failed").cast("bigint"))


@register("rule_quarantine", """
SELECT o_orderkey, concat_ws(',',
    CASE WHEN o_orderkey IS NULL THEN 'orders.o_orderkey.not_null' END,
    CASE WHEN o_totalprice < 1000.0 OR o_totalprice > 400000.0 THEN 'orders.o_totalprice.range' END,
    CASE WHEN o_orderstatus NOT IN ('F', 'O', 'P') THEN 'orders.o_orderstatus.allowed' END,
    CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$') THEN 'orders.o_orderpriority.regex' END
  ) AS failed_rules
FROM orders
WHERE o_orderkey IS NULL OR o_totalprice < 1000.0 OR o_totalprice > 400000.0
   OR o_orderstatus NOT IN ('F', 'O', 'P') OR NOT regexp_matches(o_orderpriority, '^[1-5]-[A-Z]+$')""")
def rule_quarantine(spark, d):
    """The orders rows failing any row rule, with the rules they fail (one projection + filter)."""
    q = checks.quarantine(t(spark, d, "orders"), ORDER_RULES)
    return q.select("o_orderkey", F.array_join("failed_rules", ",").alias("failed_rules"))


# --- X1 / X6: streams drained to a table -------------------------------------------------------

@register("stream_score", _GS_SQL + f"""
SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DOUBLE) AS y_true, {sr('a + slope * l_quantity')} AS y_pred
FROM lineitem JOIN co ON l_returnflag = co.g, sl""")
def stream_score(spark, d):
    from ..streaming.scoring import score_stream_to_table
    _, m = _group_slope_model(spark, d)
    schema = t(spark, d, "lineitem").schema
    out = score_stream_to_table(spark, f"{d}/lineitem*.parquet", schema, m, keep=LKEYS + ["l_extendedprice"])
    return out.select(*LKEYS, F.col("l_extendedprice").alias("y_true"), r("y_pred").alias("y_pred"))


@register("stream_latency", """
WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS ws, event_type, value FROM events)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n,
       CAST(CAST(avg(value) AS FLOAT) AS DOUBLE) AS avg_value, CAST(CAST(max(value) AS FLOAT) AS DOUBLE) AS max_value,
       CAST(CAST(list_sort(list(value) FILTER (WHERE value IS NOT NULL))[CAST(ceil(count(value) * 0.95) AS INTEGER)] AS FLOAT) AS DOUBLE) AS p95_value
FROM w WHERE ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
GROUP BY 1, 2""")
def stream_latency(spark, d):
    from ..streaming.latency import windowed_stream_to_table
    # events.ts is a wall clock; window bounds come back as the same wall clock, whatever the session's zone
    schema = t(spark, d, "events").schema
    out = windowed_stream_to_table(spark, f"{d}/events*.parquet", schema, "1 day", "1 hour")
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window_start").cast("timestamp_ntz"))
    return out.select(F.date_format(start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type",
                      "n", r("avg_value").alias("avg_value"), r("max_value").alias("max_value"),
                      r("p95_value").alias("p95_value"))


# --- M2 / M4: no SQL equivalent (rows-only checks) ----------------------------------------------

_GBT_NUM, _GBT_CAT = ["l_quantity", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus"]


@register("gbt_scores")
def gbt_scores(spark, d):
    li = _lineitem_split(spark, d)
    model = fit_gbt(li.where(F.col("split") == TRAIN), _GBT_NUM, _GBT_CAT, "l_extendedprice",
                    maxIter=20, maxDepth=5, seed=SEED)
    te = li.where(F.col("split") == TEST)
    return predict_tree(model, te, _GBT_NUM, _GBT_CAT).select(*LKEYS, F.col("l_extendedprice").alias("y_true"), "y_pred")


@register("random_search")
def random_search_q(spark, d):
    li = hash_split(t(spark, d, "lineitem"), LKEYS, TEST_SHARE, SEED, validation_fraction=0.1)
    table, _ = random_search(li.where(F.col("split") == TRAIN), li.where(F.col("split") == "validation"),
                             _GBT_NUM, _GBT_CAT, "l_extendedprice", n_trials=10, executions=3, seed=SEED,
                             keys=LKEYS)
    return table


_PENALTIES, _FOLDS = (0.0, 0.01, 0.1, 1.0), 5


def _ridge_oracle() -> str:
    """Cross-validation errors in SQL: one Gram matrix per fold, Gauss-Jordan per (fold, penalty)."""
    xs = ["l_quantity", "l_discount", "l_tax"]
    k = len(xs) + 1
    names = [f"x{i}" for i in range(k)]
    rows = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in [*names, "y"]) + "]" for a in [*names, "y"])
    size = k + 1
    add = f"list_transform(range(1, {size} + 1), lambda i: list_transform(range(1, {size} + 1), lambda j: {{}}))"
    fold = sql_hash_u32(LKEYS, f"fold {SEED}")
    penalties = ", ".join(f"({p!r}::DOUBLE)" for p in _PENALTIES)
    scaled = ", ".join(f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS x{i + 1}"
                       for i, c in enumerate(xs))
    return f"""
WITH RECURSIVE
d AS (SELECT 1.0::DOUBLE AS x0, {scaled}, l_extendedprice - avg(l_extendedprice) OVER () AS y, {fold} % {_FOLDS} AS fold
      FROM lineitem WHERE {L_TRAIN}),
g AS (SELECT fold, [{rows}] AS own FROM d GROUP BY fold),
w AS (SELECT [{rows}] AS whole FROM d),
s AS (SELECT fold, penalty, own, {add.format("whole[i][j] - own[i][j]")} AS rest
      FROM g, w, (VALUES {penalties}) AS p(penalty)),
gj(fold, penalty, own, k, m) AS (
  SELECT fold, penalty, own, 0, {add.format("rest[i][j] + CASE WHEN i = j AND i BETWEEN 2 AND " + str(k)
                                            + " THEN penalty * rest[1][1] ELSE 0 END")} FROM s
  UNION ALL
  SELECT fold, penalty, own, k + 1, list_transform(range(1, {k} + 1), lambda i:
           CASE WHEN i = k + 1 THEN list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1])
                ELSE list_transform(range(1, {size} + 1), lambda j: m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j])
           END)
  FROM gj WHERE k < {k}),
v AS (SELECT fold, penalty, own, list_append(list_transform(m, lambda r: -r[{size}]), 1.0::DOUBLE) AS v FROM gj WHERE k = {k})
SELECT penalty, CAST(fold AS INTEGER) AS fold, CAST(own[1][1] AS BIGINT) AS n,
       {sr("list_sum(list_transform(range(1, " + str(size) + " + 1), lambda i: list_sum(list_transform(range(1, "
           + str(size) + " + 1), lambda j: v[i] * own[i][j] * v[j])))) / own[1][1]")} AS mse
FROM v"""


@register("ridge_search", _ridge_oracle())
def ridge_search_q(spark, d):
    """M4 in closed form: every (penalty, fold) from one pass over the training rows."""
    li = _lineitem_split(spark, d).where(F.col("split") == TRAIN)
    fm = fit_features(li, Roles(_GBT_NUM, []), target="l_extendedprice")
    table, _, _ = ridge_search(li, fm, "l_extendedprice", _PENALTIES, _FOLDS, LKEYS, SEED)
    return table.select("penalty", "fold", "n", r("mse").alias("mse"))


def _ols_oracle() -> str:
    """Hold-out metrics of the flagship model, fitted in SQL.

    Least-squares fitted values do not depend on the parametrisation, so the
    oracle fits the full-rank reference-coded design (intercept, the three
    numerics, one 0/1 column per non-first level) and solves its normal
    equations by Gauss-Jordan elimination in a recursive CTE.
    """
    xs = ["1.0", "l_quantity", "l_discount", "l_tax", "CAST(l_returnflag = 'N' AS DOUBLE)",
          "CAST(l_returnflag = 'R' AS DOUBLE)", "CAST(l_linestatus = 'O' AS DOUBLE)"]
    k = len(xs)
    names = [f"x{i}" for i in range(k)]
    gram_rows = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in names + ["y"]) + "]" for a in names)
    return f"""
WITH RECURSIVE
d AS (SELECT {', '.join(f'{e} AS x{i}' for i, e in enumerate(xs))}, l_extendedprice AS y, {L_TEST} AS is_test
      FROM lineitem),
g AS (SELECT [{gram_rows}] AS m FROM d WHERE NOT is_test),
gj(k, m) AS (
  SELECT 0, m FROM g
  UNION ALL
  SELECT k + 1, list_transform(range(1, {k} + 1), lambda i:
           CASE WHEN i = k + 1 THEN list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1])
                ELSE list_transform(range(1, {k} + 2), lambda j: m[i][j] - m[i][k + 1] / m[k + 1][k + 1] * m[k + 1][j])
           END)
  FROM gj WHERE k < {k}),
b AS (SELECT list_transform(m, lambda r: r[{k} + 1]) AS beta FROM gj WHERE k = {k}),
pr AS (SELECT y AS y_true, {' + '.join(f'beta[{i + 1}] * x{i}' for i in range(k))} AS y_pred FROM d, b WHERE is_test)
SELECT {_METRIC_SQL} FROM pr"""


@register("workflow_metrics", _ols_oracle())
def workflow_metrics(spark, d):
    """The flagship: full linear workflow on lineitem (all numerics + one-hot), hold-out metrics."""
    from .jobs import fit_and_score
    scored, _, _ = fit_and_score(t(spark, d, "lineitem"), LKEYS, "l_extendedprice",
                                 exclude=_L_ROLES_EXCLUDE, test_size=TEST_SHARE, seed=SEED)
    return _round_metrics(regression_metrics(scored))


from . import catalog_jobs, catalog_models  # noqa: E402,F401  register their queries


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)

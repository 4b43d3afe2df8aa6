"""Registered queries over sources, sinks, jobs and edge cases (imported by ``catalog``).

The edge cases are made from the given tables: nulls, null groups and an empty
side are put in by a condition on the rows, so the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sql_hash_u32
from ..operators import drift, profile
from ..operators.features import fit_features, tag_records
from ..operators.metrics import regression_metrics, rmsle
from ..operators.models import fit_gbt, predict_tree
from ..operators.roles import Roles
from ..operators.scoring import score_strict
from ..operators.split import TEST, TRAIN, hash_split, manifest_split
from ..session import scratch_path
from ..sources.tables import read_csv, read_records, write_table
from . import catalog as C
from .catalog import CUT, L_TEST, LKEYS, LNUM, SEED, TEST_SHARE, r, register, sr, t

# --- S1, S5: CSV out and in -------------------------------------------------------------------


@register("csv_roundtrip", """
SELECT o_orderkey, o_totalprice, 'say "' || o_orderpriority || '", ok' AS note,
       CASE WHEN o_orderkey % 3 = 0 THEN '3F' ELSE '2D' END AS code, o_orderstatus FROM orders""")
def csv_roundtrip(spark, d):
    """Orders with quotes, commas and number-like text written as CSV to the shared folder and read back."""
    o = t(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.concat(F.lit('say "'), "o_orderpriority", F.lit('", ok')).alias("note"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("3F")).otherwise(F.lit("2D")).alias("code"), "o_orderstatus")
    path = scratch_path(spark, "orders-csv")
    o.write.option("header", True).option("escape", '"').csv(path)
    back = read_csv(spark, path)
    return back.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice", "note", "code",
                       "o_orderstatus")


# --- S4, P4, P5: records -------------------------------------------------------------------------

@register("json_records", """
SELECT CASE event_id % 6 WHEN 0 THEN 'ok' WHEN 4 THEN 'malformed' ELSE 'rejected' END AS status,
       CASE event_id % 6 WHEN 1 THEN 'k' WHEN 4 THEN 'id,k' ELSE '' END AS missing,
       CASE event_id % 6 WHEN 2 THEN 'k' WHEN 3 THEN 'k' WHEN 5 THEN 'k' ELSE '' END AS bad_cast,
       count(*) AS n, CAST(sum(CASE WHEN event_id % 6 <> 4 THEN event_id ELSE 0 END) AS DOUBLE) AS ids
FROM events GROUP BY 1, 2, 3""")
def json_records(spark, d):
    """Records as lines of text: whole, without a key, ``12d``, a tab, no JSON at all, a word."""
    e = t(spark, d, "events")
    k = F.col("event_id") % 6
    text = F.when(k == 0, F.format_string('{"id": %d, "k": 1.5e1, "extra": "x"}', "event_id")) \
        .when(k == 1, F.format_string('{"id": %d}', "event_id")) \
        .when(k == 2, F.format_string('{"id": %d, "k": "12d"}', "event_id")) \
        .when(k == 3, F.format_string('{"id": %d, "k": "\\\\t"}', "event_id")) \
        .when(k == 4, F.format_string('id is %d', "event_id")) \
        .otherwise(F.format_string('{"id": %d, "k": "many"}', "event_id"))
    path = scratch_path(spark, "records")
    e.select(text.alias("value")).write.text(path)
    tagged = tag_records(read_records(spark, path), "features", ["id", "k"], [])
    return tagged.groupBy("status", F.array_join("missing", ",").alias("missing"),
                          F.array_join("bad_cast", ",").alias("bad_cast")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("id"), F.lit(0.0)).alias("ids"))


# --- A4, A5: nulls in targets and predictions ------------------------------------------------------

_HOLES = "CASE WHEN x % 5 = 0 THEN NULL ELSE y_true END AS y_true, CASE WHEN x % 7 = 0 THEN NULL ELSE y_pred END AS y_pred"


@register("metrics_with_nulls", C._GS_SQL + f""", h AS (SELECT {_HOLES} FROM pr),
c AS (SELECT * FROM h WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)
SELECT {C._METRIC_SQL}, (SELECT count(*) FROM h) - count(*) AS n_unscored,
  {sr('sqrt(avg((ln(1 + y_true) - ln(1 + y_pred)) * (ln(1 + y_true) - ln(1 + y_pred))))')} AS rmsle FROM c""")
def metrics_with_nulls(spark, d):
    li, m = C._group_slope_model(spark, d)
    te = li.where(F.col("split") == TEST)
    x = F.col("l_quantity")
    rows = te.select(F.when(x % 5 != 0, F.col("l_extendedprice")).alias("y_true"),
                     F.when(x % 7 != 0, m.predict_col(te)).alias("y_pred"))
    a, b = regression_metrics(rows), rmsle(rows).select("rmsle")
    both = a.select("n", *[r(c).alias(c) for c in ["mae", "mse", "rmse", "r2"]], "n_unscored")
    return both.withColumn("rmsle", F.lit(float(b.first()[0])).cast("float").cast("double"))


# --- R12, R13, R14, X4: null groups, all pairs, nulls in wide sets, an empty side ------------------------

@register("box_stats_null_group", f"""
WITH g AS (SELECT nullif(l_returnflag, 'R') AS g, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_extendedprice END AS v
           FROM lineitem)
SELECT g, count(v) AS n, {sr('quantile_cont(v, 0.25)')} AS q1, {sr('quantile_cont(v, 0.5)')} AS median,
       {sr('quantile_cont(v, 0.75)')} AS q3 FROM g GROUP BY 1""")
def box_stats_null_group(spark, d):
    """R12 by the bracket path, with a null group and a group without values."""
    li = t(spark, d, "lineitem").select(
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("g"),
        F.when(F.col("l_returnflag") != "A", F.col("l_extendedprice")).alias("v"))
    s, _ = profile.box_stats(li, "v", "g", exact="bracket")
    return s.select("g", "n", *[r(c).alias(c) for c in ["q1", "median", "q3"]])


_WIDE = {f"w{i}": f"CASE WHEN l_linenumber % {3 + i % 4} <> {i % 3} THEN {LNUM[i % 4]} + {i} * {LNUM[(i + 1) % 4]} END"
         for i in range(40)}


@register("correlation_wide", "WITH e AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _WIDE.items())
          + " FROM lineitem), c AS (SELECT " + ", ".join(
              f"corr(w{i}, w{j}) AS c{i}_{j}" for i in range(40) for j in range(i + 1, 40)) + " FROM e)\n"
          + "\nUNION ALL\n".join(f"SELECT 'w{i}' AS a, 'w{j}' AS b, round(c{i}_{j}, 5) AS r FROM c"
                                 for i in range(40) for j in range(i + 1, 40)))
def correlation_wide(spark, d):
    """R14 over 40 columns with different nulls: pairwise-complete at this width too."""
    e = t(spark, d, "lineitem").select(*[F.expr(x).alias(c) for c, x in _WIDE.items()])
    return profile.correlation_long(e, list(_WIDE)).withColumn("r", F.round("r", 5))


_PAIRS = [(a, b) for i, a in enumerate(LNUM) for b in LNUM[i + 1:]]


@register("all_pair_bins", "WITH s AS (SELECT " + ", ".join(
    f"min({c}) AS {c}_lo, max({c}) AS {c}_hi" for c in LNUM) + " FROM lineitem)\n" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {C._sql_bin(a, a + '_lo', a + '_hi', 10)} AS bx, "
    f"{C._sql_bin(b, b + '_lo', b + '_hi', 10)} AS by, CAST(count(*) AS BIGINT) AS n FROM lineitem, s GROUP BY 3, 4"
    for a, b in _PAIRS))
def all_pair_bins(spark, d):
    return profile.all_pair_bins(t(spark, d, "lineitem"), LNUM, 10)


@register("ks_empty_side", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, CAST(NULL AS DOUBLE) AS ks, count({c}) AS n_ref, CAST(0 AS BIGINT) AS n_cur FROM lineitem"
    for c in ["l_quantity", "l_discount"]))
def ks_empty_side(spark, d):
    """X4 by the range path, without any current row."""
    out = drift.ks(t(spark, d, "lineitem"), ["l_quantity", "l_discount"], F.lit(True), max_distinct=0)
    return out.select("feature", "ks", F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"))


# --- L3, L5 -----------------------------------------------------------------------------------------

_VALID = CUT + int(((1 << 32) - CUT) * 0.1)
_H = sql_hash_u32(LKEYS, SEED)


@register("split_validation", f"""
SELECT CASE WHEN {_H} < {CUT} THEN 'test' WHEN {_H} < {_VALID} THEN 'validation' ELSE 'train' END AS split,
       count(*) AS n FROM lineitem GROUP BY 1""")
def split_validation(spark, d):
    s = hash_split(t(spark, d, "lineitem"), LKEYS, TEST_SHARE, SEED, validation_fraction=0.1)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("split_manifest", """
SELECT CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'test' ELSE 'train' END AS split,
       count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def split_manifest(spark, d):
    """A manifest that lists keys twice and leaves some out: every row stays, once."""
    o = t(spark, d, "orders").where("o_orderkey % 4 <> 0").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.when(F.col("o_orderkey") % 4 == 1, F.lit(TEST)).otherwise(F.lit(TRAIN)).alias("split"))
    li = t(spark, d, "lineitem").join(t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey")),
                                      "l_orderkey", "left_semi")
    return manifest_split(li, o.unionByName(o), "l_orderkey").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- M2: one tree of depth one is SQL -------------------------------------------------------------------

@register("tree_stump", f"""
WITH tr AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem WHERE NOT ({L_TEST})),
s AS (SELECT x, count(*) AS n, sum(y) AS s FROM tr GROUP BY 1),
c AS (SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
      FROM s WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
best AS (SELECT x AS cut, sl / nl AS lo, (st - sl) / (nt - nl) AS hi FROM c WHERE nt > nl
         ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)
SELECT {sr('CASE WHEN l_quantity <= cut THEN lo ELSE hi END')} AS y_pred, count(*) AS n,
       CAST(min(l_quantity) AS DOUBLE) AS x_min, CAST(max(l_quantity) AS DOUBLE) AS x_max
FROM lineitem, best WHERE {L_TEST} GROUP BY 1""")
def tree_stump(spark, d):
    """Depth one on one column with fewer values than bins: the best cut and two means."""
    li = C._lineitem_split(spark, d)
    model = fit_gbt(li.where(F.col("split") == TRAIN), ["l_quantity"], [], "l_extendedprice",
                    maxIter=1, maxDepth=1, maxBins=64, seed=SEED)
    out = predict_tree(model, li.where(F.col("split") == TEST), ["l_quantity"], [])
    return out.groupBy(r("y_pred").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_quantity").cast("double").alias("x_min"),
        F.max("l_quantity").cast("double").alias("x_max"))


# --- J1-J5: the workflow as jobs, with its ledger, sinks and artifacts ------------------------------------

def _workflow(spark, d) -> tuple[DataFrame, dict]:
    from ..operators.ledger import Ledger
    from .jobs import JobSpec, run_evaluation, run_offline_workflow

    spec = JobSpec(f"{d}/lineitem.parquet", "l_extendedprice", scratch_path(spark, "ledger"), keys=tuple(LKEYS),
                   exclude=tuple(C._L_ROLES_EXCLUDE), test_size=TEST_SHARE, seed=SEED, split_method="hash",
                   data_format="parquet")
    ids = run_offline_workflow(spark, spec)
    # evaluated once more by itself: model, statistics, split keys and share come from the ledger
    ids["again"] = run_evaluation(spark, spec, ids["training"])
    return Ledger(spark, spec.ledger_root), ids


_FLAGSHIP = C.ORACLE["workflow_metrics"]


@register("job_metrics", f"""
WITH m AS ({_FLAGSHIP})
SELECT s.run, m.mae, m.mse, m.rmse, m.r2 FROM m, (VALUES ('again'), ('evaluation'), ('training')) AS s(run)""")
def job_metrics(spark, d):
    """Hold-out metrics as the training, evaluation and a later evaluation run logged them."""
    ledger, ids = _workflow(spark, d)
    m = ledger.metrics().where(F.col("key").rlike("^(eval_)?(mae|mse|rmse|r2)$"))
    name = F.when(F.col("run_id") == ids["training"], F.lit("training")).when(
        F.col("run_id") == ids["evaluation"], F.lit("evaluation")).otherwise(F.lit("again"))
    m = m.select(name.alias("run"), F.regexp_replace("key", "^eval_", "").alias("key"), "value")
    m = m.groupBy("run").pivot("key", ["mae", "mse", "rmse", "r2"]).agg(F.first("value"))
    return m.select("run", *[r(c).alias(c) for c in ["mae", "mse", "rmse", "r2"]])


@register("job_predictions", f"""
WITH m AS ({_FLAGSHIP}) SELECT 'FINISHED' AS status, CAST(1 AS BIGINT) AS feature_runs, m.n, m.mae, m.rmse FROM m""")
def job_predictions(spark, d):
    """The evaluation's predictions table read back, with its run and lineage."""
    from ..operators.ledger import get_run, lineage

    ledger, ids = _workflow(spark, d)
    p = spark.read.parquet(ledger.artifact_path(ids["again"], "predictions"))
    runs = ledger.runs()
    status = get_run(runs, ids["again"]).first()["status"]
    parents = lineage(runs).where(F.col("run_id") == ids["training"]).where(F.col("feature_run_name").isNotNull()).count()
    e = F.col("residual")
    return p.agg(F.lit(status).alias("status"), F.lit(parents).cast("bigint").alias("feature_runs"),
                 F.count(e).alias("n"), r(F.avg(F.abs(e))).alias("mae"), r(F.sqrt(F.avg(e * e))).alias("rmse"))


@register("job_strict", C._GS_SQL + f"""
SELECT CASE WHEN l_orderkey % 10 = 0 THEN 'rejected' ELSE 'ok' END AS status, count(*) AS n,
       CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE {sr('avg(a + slope * l_quantity)')} END AS y_pred
FROM lineitem JOIN co ON l_returnflag = co.g, sl GROUP BY l_orderkey % 10 = 0""")
def job_strict(spark, d):
    """Every line item as a text record; a tenth lacks a feature."""
    from ..operators.scoring import prediction_log

    li, m = C._group_slope_model(spark, d)
    fm = fit_features(li.where(F.col("split") == TRAIN), Roles(["l_quantity"], ["l_returnflag"]),
                      target="l_extendedprice")
    full = F.create_map(F.lit("l_quantity"), F.col("l_quantity").cast("string"), F.lit("l_returnflag"), "l_returnflag")
    part = F.create_map(F.lit("l_quantity"), F.col("l_quantity").cast("string"))
    rec = li.select(F.when(F.col("l_orderkey") % 10 == 0, part).otherwise(full).alias("features"))
    ok, rejects = score_strict(rec, "features", fm, m)
    path = scratch_path(spark, "predictions-log")
    write_table(prediction_log(ok, "run", ["l_quantity", "l_returnflag"], "linear_regression"), path, mode="append")
    log = spark.read.parquet(path).where("model_type = 'linear_regression' and inputs like '%l_quantity%'")
    a = log.agg(F.lit("ok").alias("status"), F.count(F.lit(1)).alias("n"), r(F.avg("prediction")).alias("y_pred"))
    b = rejects.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("y_pred"))
    return a.unionByName(b)

"""Registered queries over jobs and models (imported by ``catalog``): requests routed to runs, boosted stumps, the
tuning job, the prediction job, the logged profile and training history, and an index column.

Boosted trees of depth one on one column with fewer values than bins are SQL: the best cut of a
running sum, twice.
"""

from __future__ import annotations

from dataclasses import replace


from pyspark.sql import functions as F

from ..functions.hashing import sql_hash_u32, threshold
from ..operators.ledger import Ledger
from ..operators.models import fit_gbt, predict_tree
from ..operators.split import TEST, TRAIN
from ..session import scratch_path
from . import catalog as C
from .catalog import CUT, L_TEST, LKEYS, SEED, TEST_SHARE, r, register, sr, t
from .jobs import (JobSpec, run_evaluation, run_feature_engineering, run_inference, run_prediction, run_training, run_tuning)

RATE = 0.1  # step size of the boosted stumps
STUMP = {"maxDepth": 1, "maxBins": 64}


def _stumps(p: str, where: str) -> str:
    """CTEs of two boosted stumps of y on x over the rows of ``base`` that meet ``where``; ``{p}m`` has both cuts and means."""
    def cut(name, source):
        return f"""
{p}{name}c AS (SELECT x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
      FROM {source} WINDOW w AS (ORDER BY x ROWS UNBOUNDED PRECEDING)),
{p}{name} AS (SELECT x AS cut{name}, sl / nl AS lo{name}, (st - sl) / (nt - nl) AS hi{name} FROM {p}{name}c WHERE nt > nl
      ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)"""
    return f"""
{p}s AS (SELECT x, count(*) AS n, sum(y) AS s FROM base WHERE {where} GROUP BY 1),{cut("a", f"{p}s")},
{p}r AS (SELECT x, n, 2 * (s - n * CASE WHEN x <= cuta THEN loa ELSE hia END) AS s FROM {p}s, {p}a),{cut("b", f"{p}r")},
{p}m AS (SELECT * FROM {p}a, {p}b)"""


ONE = "CASE WHEN x <= cuta THEN loa ELSE hia END"
TWO = f"({ONE} + {RATE} * CASE WHEN x <= cutb THEN lob ELSE hib END)"
BASE = f"base AS (SELECT l_quantity AS x, l_extendedprice AS y, {L_TEST} AS is_test FROM lineitem)"


@register("gbt_two_rounds", f"""
WITH {BASE}, {_stumps('f', 'NOT is_test')}
SELECT {sr(TWO)} AS y_pred, count(*) AS n, CAST(min(x) AS DOUBLE) AS x_min, CAST(max(x) AS DOUBLE) AS x_max
FROM base, fm WHERE is_test GROUP BY 1""")
def gbt_two_rounds(spark, d):
    """M2: two boosted stumps, the second on what the first leaves."""
    li = C._lineitem_split(spark, d)
    model = fit_gbt(li.where(F.col("split") == TRAIN), ["l_quantity"], [], "l_extendedprice", maxIter=2, stepSize=RATE,
                    seed=SEED, **STUMP)
    out = predict_tree(model, li.where(F.col("split") == TEST), ["l_quantity"], [])
    return out.groupBy(r("y_pred").alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_quantity").cast("double").alias("x_min"),
        F.max("l_quantity").cast("double").alias("x_max"))


# --- jobs over lineitem with one feature ----------------------------------------------------

def _spec(spark, d, **options) -> JobSpec:
    others = tuple(c for c in t(spark, d, "lineitem").columns if c not in ("l_quantity", "l_extendedprice"))
    return JobSpec(f"{d}/lineitem.parquet", "l_extendedprice", scratch_path(spark, "ledger"), keys=tuple(LKEYS),
                   exclude=others, test_size=TEST_SHARE, seed=SEED, split_method="hash", data_format="parquet", **options)


_BOOSTED = {"model_type": "gbt", "hyperparameters": {**STUMP, "maxIter": 2, "stepSize": RATE, "seed": SEED}}
_LINE = f"""line AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS mean FROM base WHERE NOT is_test)"""


def _request(line: str, trees: str):
    """Columns of requests: a run and a quantity as text, with gaps and text that is no number."""
    run = F.when(F.col("l_orderkey") % 4 == 0, F.lit(line)).when(F.col("l_orderkey") % 4 == 1, F.lit(trees)).when(
        F.col("l_orderkey") % 4 == 2, F.lit("nope"))  # without one: the newest, which is the tree run
    text = F.when(F.col("l_orderkey") % 5 == 0, F.lit(" ")).when(F.col("l_orderkey") % 7 == 0, F.lit("many")).otherwise(
        F.col("l_quantity").cast("string"))
    return run.alias("run"), text.alias("l_quantity")


@register("job_requests", f"""
WITH {BASE}, {_stumps('f', 'NOT is_test')}, {_LINE},
q AS (SELECT CASE l_orderkey % 4 WHEN 0 THEN 'linear_regression' WHEN 2 THEN NULL ELSE 'gbt' END AS model_type,
             l_orderkey % 5 = 0 AS gap, l_orderkey % 5 <> 0 AND l_orderkey % 7 = 0 AS bad, CAST(l_quantity AS DOUBLE) AS given
      FROM lineitem),
x AS (SELECT model_type, gap, bad, CASE WHEN gap THEN mean ELSE given END AS x, a, b, cuta, loa, hia, cutb, lob, hib
      FROM q, line, fm),
p AS (SELECT model_type, CASE WHEN model_type IS NULL THEN 'not_found' WHEN bad THEN 'bad_request' ELSE 'ok' END AS status,
             CASE WHEN model_type IS NULL THEN 'Run nope not found' WHEN bad THEN 'not a number: l_quantity' END AS reason,
             CAST(gap AND model_type IS NOT NULL AS INTEGER) AS filled,
             CASE WHEN bad THEN NULL WHEN model_type = 'linear_regression' THEN a + b * x WHEN model_type = 'gbt' THEN {TWO} END AS p
      FROM x)
SELECT model_type, status, reason, count(*) AS n, CAST(sum(filled) AS BIGINT) AS filled, {sr('avg(p)')} AS y_pred
FROM p GROUP BY ALL""")
def job_requests(spark, d):
    """Line items as requests to a linear run, a tree run, the newest run and an unknown one, in one scan."""
    spec = _spec(spark, d)
    fe = run_feature_engineering(spark, spec)
    line = run_training(spark, spec, feature_run_id=fe)
    trees = run_training(spark, replace(spec, **_BOOSTED), feature_run_id=fe)
    out = run_inference(spark, spec, t(spark, d, "lineitem").select(*_request(line, trees)), "run")
    return out.groupBy("model_type", "status", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("imputed"), F.lit(0))).cast("bigint").alias("filled"),
        r(F.avg("y_pred")).alias("y_pred"))


VALID = threshold(0.1)
_PART = sql_hash_u32(LKEYS, f"validation {SEED}")


@register("job_tuning", f"""
WITH base AS (SELECT l_quantity AS x, l_extendedprice AS y, {L_TEST} AS is_test, {_PART} < {VALID} AS is_valid FROM lineitem),
{_stumps('v', 'NOT is_test AND NOT is_valid')}, {_stumps('f', 'NOT is_test')},
trial AS (SELECT avg(pow(y - {ONE}, 2)) AS one, avg(pow(y - {TWO}, 2)) AS two FROM base, vm WHERE NOT is_test AND is_valid),
e AS (SELECT is_test, y - {ONE} AS one, y - {TWO} AS two FROM base, fm)
SELECT CAST(CASE WHEN two < one THEN 2 ELSE 1 END AS BIGINT) AS rounds, {sr('least(one, two)')} AS val_mse,
       (SELECT {sr('avg(one * one)')} FROM e WHERE NOT is_test) AS first_loss,
       (SELECT {sr('avg(CASE WHEN trial.two < trial.one THEN e.two * e.two ELSE e.one * e.one END)')} FROM e WHERE NOT is_test) AS last_loss,
       (SELECT {sr('avg(abs(CASE WHEN trial.two < trial.one THEN e.two ELSE e.one END))')} FROM e WHERE NOT is_test) AS train_mae,
       (SELECT {sr('avg(abs(CASE WHEN trial.two < trial.one THEN e.two ELSE e.one END))')} FROM e WHERE is_test) AS eval_mae
FROM trial""")
def job_tuning(spark, d):
    """M4-M6: stumps of one or two rounds tried on validation rows, the better refitted, recorded and evaluated."""
    spec = _spec(spark, d, **{**_BOOSTED, "hyperparameters": STUMP})
    space = {"maxIter": [1, 2], "stepSize": [RATE]}
    ids = run_tuning(spark, spec, n_trials=2, executions=1, validation=0.1, space=space, rungs=(1.0,))
    ledger = Ledger(spark, spec.ledger_root)
    m = ledger.metrics().select(F.concat(F.when(F.col("run_id") == ids["training"], F.lit("train_")).when(
        F.col("run_id") == ids["evaluation"], F.lit("")).otherwise(F.lit("tuning_")), "key").alias("key"), "value", "step")

    def value(key, first=False):
        pick = F.min_by if first else F.max_by
        return r(pick("value", F.when(F.col("key") == key, F.col("step"))))

    return m.agg(F.max(F.when(F.col("key") == "train_train_loss", F.col("step"))).cast("bigint").alias("rounds"),
                 value("tuning_best_val_mse").alias("val_mse"), value("train_train_loss", True).alias("first_loss"),
                 value("train_train_loss").alias("last_loss"), value("train_train_mae_final").alias("train_mae"),
                 value("eval_mae").alias("eval_mae"))


@register("job_prediction", f"""
WITH {BASE}, {_LINE},
p AS (SELECT l_orderkey % 10 = 0 AS short, l_orderkey % 10 <> 0 AND l_orderkey % 11 = 0 AS bad, a + b * CAST(l_quantity AS DOUBLE) AS p
      FROM lineitem, line)
SELECT CASE WHEN short OR bad THEN 'rejected' ELSE 'ok' END AS status, CASE WHEN short THEN 'l_quantity' ELSE '' END AS missing,
       CASE WHEN bad THEN 'l_quantity' ELSE '' END AS bad_cast, count(*) AS n,
       CASE WHEN short OR bad THEN NULL ELSE {sr('avg(p)')} END AS y_pred
FROM p GROUP BY short, bad""")
def job_prediction(spark, d):
    """The prediction job over a folder of JSON records, read back from its log and its rejects."""
    spec = _spec(spark, d)
    run_training(spark, spec, feature_run_id=run_feature_engineering(spark, spec))
    text = F.when(F.col("l_orderkey") % 10 == 0, F.lit(None)).when(F.col("l_orderkey") % 11 == 0, F.lit("12 pieces")).otherwise(
        F.col("l_quantity").cast("string"))
    records = scratch_path(spark, "records")
    t(spark, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("order"), text.alias("l_quantity")).write.json(records)
    out = scratch_path(spark, "predictions")
    run_prediction(spark, spec, records, out_dir=out)
    log, rejects = spark.read.parquet(f"{out}/predictions_log"), spark.read.parquet(f"{out}/rejects")
    a = log.agg(F.lit("ok").alias("status"), F.lit("").alias("missing"), F.lit("").alias("bad_cast"),
                F.count(F.lit(1)).alias("n"), r(F.avg("prediction")).alias("y_pred"))
    b = rejects.groupBy("status", F.array_join("missing", ",").alias("missing"),
                        F.array_join("bad_cast", ",").alias("bad_cast")).agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("y_pred"))
    return a.unionByName(b)


# --- the logged profile, and an index column -------------------------------------------------------

@register("job_profile", """
WITH p AS (SELECT count(*) AS n, count(*) - count(CASE WHEN o_orderkey % 9 > 0 THEN o_totalprice END) AS gaps FROM orders)
SELECT k AS key, v AS value FROM p, (VALUES
  ('data_rows', CAST(n AS VARCHAR)), ('data_columns', '3'), ('num_numeric_features', '1'), ('num_categorical_features', '1'),
  ('total_transformed_features', CAST(1 + (SELECT count(DISTINCT o_orderpriority) FROM orders) AS VARCHAR)),
  ('nulls of o_orderkey', '0'), ('nulls of o_orderpriority', '0'), ('nulls of o_totalprice', CAST(gaps AS VARCHAR))) AS s(k, v)""")
def job_profile(spark, d):
    """What a feature run logged about its table, read from the ledger."""
    path = scratch_path(spark, "orders")
    t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 > 0, F.col("o_totalprice")).alias("o_totalprice"),
                                 "o_orderpriority").write.parquet(path)
    spec = JobSpec(path, "o_orderkey", scratch_path(spark, "ledger"), test_size=0.0, split_method="hash", data_format="parquet")
    run = run_feature_engineering(spark, spec)
    ledger = Ledger(spark, spec.ledger_root)
    keys = ["data_rows", "data_columns", "num_numeric_features", "num_categorical_features", "total_transformed_features"]
    params = ledger.params().where((F.col("run_id") == run) & F.col("key").isin(keys)).select("key", "value")
    nulls = ledger.artifacts().where((F.col("run_id") == run) & (F.col("kind") == "null_counts")).select(
        F.explode(F.from_json("content", "map<string,bigint>")))
    return params.unionByName(nulls.select(F.concat(F.lit("nulls of "), "key").alias("key"), F.col("value").cast("string")))


@register("job_index", f"""
WITH e AS (SELECT event_id, event_type, CAST(value AS DOUBLE) AS y, {sql_hash_u32(['event_id'], SEED)} < {CUT} AS is_test FROM events),
m AS (SELECT event_type, avg(y) AS p FROM e WHERE NOT is_test GROUP BY 1)
SELECT event_id, {sr('y')} AS y_true, {sr('p')} AS y_pred FROM e JOIN m USING (event_type) WHERE is_test""")
def job_index(spark, d):
    """An index column splits, stays out of the features and comes back with the predictions."""
    others = tuple(c for c in t(spark, d, "events").columns if c not in ("event_id", "event_type", "value"))
    spec = JobSpec(f"{d}/events.parquet", "value", scratch_path(spark, "ledger"), index_column="event_id", exclude=others,
                   test_size=TEST_SHARE, seed=SEED, split_method="hash", data_format="parquet")
    run = run_training(spark, spec, feature_run_id=run_feature_engineering(spark, spec))
    again = run_evaluation(spark, spec, run)
    p = spark.read.parquet(Ledger(spark, spec.ledger_root).artifact_path(again, "predictions"))
    return p.select("event_id", r("y_true").alias("y_true"), r("y_pred").alias("y_pred"))


# --- S9: a run store written and read ------------------------------------------------------------------

@register("run_store", """
WITH m AS (SELECT md5(CAST(user_id AS VARCHAR)) AS run_id, event_type || ' value/daily 100%' AS key, count(*) AS n,
                  CAST(CAST(sum(value) AS FLOAT) AS DOUBLE) AS total, max(event_id) AS last_step, epoch_us(max(ts)) // 1000 AS last_ms
           FROM events GROUP BY ALL),
r AS (SELECT md5(CAST(user_id AS VARCHAR)) AS run_id, epoch_us(min(ts)) // 1000 AS start_ms,
             CASE WHEN user_id % 4 = 0 THEN 'RUNNING' ELSE 'FINISHED' END AS status, user_id AS split_seed FROM events GROUP BY user_id)
SELECT run_id, key, n, total, last_step, last_ms, start_ms, status, split_seed FROM m JOIN r USING (run_id)""")
def run_store(spark, d):
    """Events as runs, one tiny file per metric, parameter and tag, written and read through the data source."""
    from ..sources.runstore import read_run_store, write_run_store

    # events.ts is a wall clock: its milliseconds as if it were UTC, whatever the session's zone
    ms = F.unix_millis(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))
    e = t(spark, d, "events").withColumn("ms", ms)
    run_id = F.md5(F.col("user_id").cast("string")).alias("run_id")
    metrics = e.select(run_id, F.lit("metric").alias("kind"), F.concat("event_type", F.lit(" value/daily 100%")).alias("key"),
                       F.col("event_id").cast("int").alias("line"),
                       F.concat_ws(" ", F.col("ms").cast("string"), F.col("value").cast("string"),
                                   F.col("event_id").cast("string")).alias("value"))
    per = e.groupBy("user_id").agg(F.min("ms").alias("first"), F.max("ms").alias("last"))
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), F.lit(i).alias("line"), v.alias("value"))
                     for i, (kind, key, v) in enumerate([
                         ("meta", "run_name", F.concat(F.lit("user "), F.col("user_id").cast("string"))),
                         ("meta", "status", F.when(F.col("user_id") % 4 == 0, F.lit("1")).otherwise(F.lit("3"))),
                         ("meta", "start_time", F.col("first").cast("string")), ("meta", "end_time", F.col("last").cast("string")),
                         ("param", "random_state", F.col("user_id").cast("string")), ("tag", "stage", F.lit("training"))])])
    described = per.select(run_id, F.explode(rows).alias("v")).select("run_id", "v.*")
    root = scratch_path(spark, "runstore")
    write_run_store(metrics.unionByName(described), root)
    back = read_run_store(spark, root)
    m = back["metrics"].groupBy("run_id", "key").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("value")).alias("total"), F.max("step").alias("last_step"),
        F.unix_millis(F.max("ts")).alias("last_ms"))
    runs = back["runs"].select("run_id", F.unix_millis("start_ts").alias("start_ms"), "status", "split_seed")
    return m.join(runs, "run_id").select("run_id", "key", "n", "total", "last_step", "last_ms", "start_ms", "status", "split_seed")


# --- M1 over Gram blocks --------------------------------------------------------------------------------

@register("workflow_metrics_blocks", C.ORACLE["workflow_metrics"])
def workflow_metrics_blocks(spark, d):
    """M1 through the path for wide designs (blocks of 3 columns, conjugate gradients), forced on the flagship's design."""
    from ..operators.features import fit_features
    from ..operators.metrics import regression_metrics
    from ..operators.roles import infer_roles
    from ..operators.scoring import score_holdout
    from ..operators.wide import fit_linear_wide

    li = C._lineitem_split(spark, d)
    train = li.where(F.col("split") == TRAIN)
    fm = fit_features(train, infer_roles(li, exclude=[*C._L_ROLES_EXCLUDE, "split"]), target="l_extendedprice")
    model = fit_linear_wide(train, fm, "l_extendedprice", block=3)
    return C._round_metrics(regression_metrics(score_holdout(li.where(F.col("split") == TEST), model, "l_extendedprice", LKEYS)))


# --- streams, sketches, drift over time, validation, a compacted ledger ---------------------------------------

@register("stream_requests", C.ORACLE["job_requests"])
def stream_requests(spark, d):
    """The requests of ``job_requests`` as a stream, micro-batches written by their id."""
    from ..streaming.requests import score_request_stream

    spec = _spec(spark, d)
    fe = run_feature_engineering(spark, spec)
    line = run_training(spark, spec, feature_run_id=fe)
    trees = run_training(spark, replace(spec, **_BOOSTED), feature_run_id=fe)

    def prepare(batch):
        return batch.select(*_request(line, trees))

    rows, log = score_request_stream(spark, spec.ledger_root, f"{d}/lineitem*.parquet", t(spark, d, "lineitem").schema, "run",
                                     prepare=prepare)
    out = rows.join(F.broadcast(log.select("batch", (F.col("scored") + F.col("rejects")).alias("logged"))), "batch")
    return out.where("logged > 0").groupBy("model_type", "status", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("imputed"), F.lit(0))).cast("bigint").alias("filled"),
        r(F.avg("y_pred")).alias("y_pred"))


def _sketch_sql() -> str:
    from ..streaming.sketches import K

    p95 = "list_sort(list(value))[CAST(ceil(count(value) * 0.95) AS INTEGER)]"
    return f"""
SELECT strftime(date_trunc('month', ts), '%Y-%m') AS month, event_type, count(*) AS n, {sr('avg(value)')} AS mean,
       {sr('max(value)')} AS greatest, CASE WHEN count(*) <= {K} THEN {sr(p95)} END AS p95, true AS within
FROM events GROUP BY 1, 2"""


@register("latency_sketch", _sketch_sql())
def latency_sketch(spark, d):
    """Daily sketches stored, months merged from them; p95 exact for small months, else its rank within the bound."""
    from ..streaming.sketches import K, event_time, merge_windows, rank_error, window_sketches

    e = t(spark, d, "events")
    path = scratch_path(spark, "window-sketches")
    window_sketches(e).write.parquet(path)
    start = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("window_start").cast("timestamp_ntz"))
    months = merge_windows(spark.read.parquet(path), [F.date_format(start, "yyyy-MM").alias("month"), "event_type"], [0.95])
    at = F.convert_timezone(F.current_timezone(), F.lit("UTC"), event_time(e, "ts").cast("timestamp_ntz"))
    rows = e.select(F.date_format(at, "yyyy-MM").alias("month"), "event_type", "value")
    rank = rows.join(F.broadcast(months.select("month", "event_type", "p95", "n")), ["month", "event_type"]).groupBy(
        "month", "event_type").agg(F.max("n").alias("n"), F.count(F.when(F.col("value") < F.col("p95"), 1)).alias("below"),
                                   F.count(F.when(F.col("value") <= F.col("p95"), 1)).alias("upto"))
    low, high = 0.95 - rank_error(), 0.95 + rank_error()
    within = (F.col("upto") >= low * F.col("n")) & (F.col("below") <= high * F.col("n"))
    out = months.join(rank.select("month", "event_type", within.alias("within")), ["month", "event_type"])
    return out.select("month", "event_type", "n", r("mean").alias("mean"), r("greatest").alias("greatest"),
                      F.when(F.col("n") <= K, r("p95")).alias("p95"), "within")


@register("drift_by_month", f"""
WITH l AS ({C._LONG_SQL.replace(' AS ref,', " AS ref, strftime(l_shipdate, '%Y-%m') AS month,")}),
e AS (SELECT feature, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM l WHERE ref GROUP BY 1),
b AS (SELECT l.feature, ref, month, {' + '.join(f'CAST(value > q[{i}] AS INT)' for i in range(1, 10))} AS bin FROM l JOIN e USING (feature)),
g AS (SELECT feature, unnest(range(0, 10)) AS bin FROM e),
rc AS (SELECT feature, bin, count(*) AS k FROM b WHERE ref GROUP BY 1, 2),
cc AS (SELECT month, feature, bin, count(*) AS k FROM b WHERE NOT ref GROUP BY 1, 2, 3),
m AS (SELECT DISTINCT month, feature FROM cc),
f AS (SELECT m.month, g.feature, g.bin, coalesce(rc.k, 0) AS r, coalesce(cc.k, 0) AS c FROM m JOIN g USING (feature)
      LEFT JOIN rc USING (feature, bin) LEFT JOIN cc USING (month, feature, bin)),
s AS (SELECT *, sum(r) OVER w AS nr, sum(c) OVER w AS nc, sum(r) OVER (w ORDER BY bin ROWS UNBOUNDED PRECEDING) AS fr,
             sum(c) OVER (w ORDER BY bin ROWS UNBOUNDED PRECEDING) AS fc FROM f WINDOW w AS (PARTITION BY month, feature))
SELECT month, feature, {sr('sum((greatest(c / nc, 1e-6) - greatest(r / nr, 1e-6)) * ln(greatest(c / nc, 1e-6) / greatest(r / nr, 1e-6)))')} AS psi,
       {sr('max(abs(fr / nr - fc / nc))')} AS ks, CAST(any_value(nr) AS BIGINT) AS n_ref, CAST(any_value(nc) AS BIGINT) AS n_cur
FROM s GROUP BY 1, 2""")
def drift_by_month(spark, d):
    """X3, X4 over time: months compared with a stored profile of the reference, made in two halves and merged."""
    from ..operators import profiles

    li = t(spark, d, "lineitem")
    ref = li.where(C._is_ref())
    path = scratch_path(spark, "profile")
    whole = profiles.build(ref, C._DRIFT_COLS)
    edges = whole.select("feature", "edges")
    profiles.merge(profiles.count(ref.where("l_orderkey % 2 = 0"), C._DRIFT_COLS, edges),
                   profiles.count(ref.where("l_orderkey % 2 <> 0"), C._DRIFT_COLS, edges)).write.parquet(path)
    cur = li.where(~C._is_ref()).withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    out = profiles.compare(cur, C._DRIFT_COLS, spark.read.parquet(path), ["month"])
    return out.select("month", "feature", r("psi").alias("psi"), r("ks").alias("ks"), F.col("n_ref").cast("bigint").alias("n_ref"),
                      F.col("n_cur").cast("bigint").alias("n_cur"))


@register("rule_validate", """
WITH o AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS k, o_totalprice AS price FROM orders),
d AS (SELECT k FROM o GROUP BY k HAVING count(*) > 1),
f AS (SELECT o.k, price < 1000.0 OR price > 400000.0 AS far, d.k IS NOT NULL AS again FROM o LEFT JOIN d USING (k))
SELECT 'price in range' AS rule, count(*) AS checked, count(*) FILTER (WHERE far) AS failed,
       (SELECT count(*) FROM f WHERE far OR again) AS quarantined FROM f
UNION ALL SELECT 'unique key', count(*), count(*) FILTER (WHERE again), (SELECT count(*) FROM f WHERE far OR again) FROM f""")
def rule_validate(spark, d):
    """Report and quarantine from one pass; some keys are made to repeat."""
    from ..operators import checks

    o = t(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 50 == 0, F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("k"),
        F.col("o_totalprice").alias("price"))
    sink = scratch_path(spark, "quarantine")
    report = checks.validate(o, [checks.Rule("price in range", "range", "price", (1000.0, 400000.0)),
                                 checks.Rule("unique key", "unique", "k")], sink)
    return report.withColumn("quarantined", F.lit(spark.read.parquet(sink).count()).cast("bigint"))


@register("ledger_compacted", C.ORACLE["latest_by_stage"])
def ledger_compacted(spark, d):
    """Events appended as run records in many files, compacted half-way; the views stay the same."""
    import os

    from ..operators.ledger import RECORD_SCHEMA, latest_by_stage
    from .ledger_views import runs_from_events

    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    runs = runs_from_events(t(spark, d, "events")).withColumn("version", F.lit(0))
    have = {f.name for f in runs.schema.fields}
    fields = [f.split() for f in RECORD_SCHEMA.split(", ")]
    records = runs.select(F.lit("run").alias("kind"), *[
        (F.col(n) if n in have else F.lit(None)).cast(k).alias(n) for n, k in fields if n != "kind"])
    half = F.xxhash64("run_id") % 2 == 0
    path = os.path.join(ledger.root, "records")
    records.where(half).repartition(20).write.mode("append").partitionBy("kind").parquet(path)
    ledger.compact()
    records.where(~half).repartition(20).write.mode("append").partitionBy("kind").parquet(path)
    ledger.compact()
    ledger.vacuum()
    return latest_by_stage(ledger.runs(), status=None).select(
        "stage", F.col("run_id").cast("bigint").alias("run_id"), F.col("parent_id").cast("bigint").alias("parent_id"))

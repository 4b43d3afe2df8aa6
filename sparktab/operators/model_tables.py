"""Fitted models as tables, and scoring by joins with them (C4).

However many runs a request table names, it is scanned once.  Runs whose models have up to ``ROW_ENTRIES``
features, coefficients and nodes become one row each (``models``): one join brings a request its
run's model, and the rest is one expression per request, without a shuffle of the requests.  With larger
models every request is joined with its run's features (one row per feature), these with the run's
coefficients, and requests of tree runs walk the run's node table, one level of all trees per join.
Nothing is looped over on the driver except the levels of the deepest tree.

* ``features``: (feature_run_id, pos, feature, is_numeric, mean, scale, fill), from the feature models in the ledger;
* ``terms``: (run_id, feature, level, w) and ``intercepts``: (run_id, intercept), from the linear models in the ledger;
* ``tree_nodes``: one row per node, written by training beside the saved model.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import to_double
from ..session import file_system, hadoop_path, scratch_path
from .features import is_missing
from .ledger import Ledger, current_runs

NODES = ("run_id string, tree int, weight double, node int, depth int, feature string, threshold double, "
         "levels array<string>, negate boolean, on_left boolean, left int, right int, value double")
FEW_ROWS = 200_000   # so many narrow model rows are broadcast; more are joined
ROW_ENTRIES = 2_000  # features, coefficients and nodes of a model that every request takes along
NO_LEVEL = "\u0000"  # stands for the level of a numeric term


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(FEW_ROWS + 1).count() <= FEW_ROWS else df


# --- from the ledger ----------------------------------------------------------

_FEATURES = ("numeric array<string>, categorical array<string>, numeric_means map<string,double>, "
             "numeric_stds_pop map<string,double>, categorical_levels map<string,map<string,bigint>>")


def features(ledger: Ledger) -> DataFrame:
    """One row per feature of every feature run: role, scaling, and what stands in for a missing value."""
    art = ledger.artifacts().where("kind = 'feature_model' and content is not null")
    m = art.select("run_id", F.from_json("content", _FEATURES).alias("m")).select("run_id", "m.*")
    std = F.try_element_at("numeric_stds_pop", "feature")
    mean = F.try_element_at("numeric_means", "feature")
    num = m.select("*", F.posexplode("numeric").alias("pos", "feature")).select(
        F.col("run_id").alias("feature_run_id"), "pos", "feature", F.lit(True).alias("is_numeric"), mean.alias("mean"),
        F.when(std > 0, std).otherwise(F.lit(1.0)).alias("scale"), mean.cast("string").alias("fill"))
    # the most frequent level; ties go to the largest
    counts = F.map_entries(F.try_element_at("categorical_levels", "feature"))
    mode = F.array_max(F.transform(counts, lambda e: F.struct(e["value"].alias("n"), e["key"].alias("level"))))
    cat = m.select("*", F.posexplode("categorical").alias("pos", "feature")).select(
        F.col("run_id").alias("feature_run_id"), (F.size("numeric") + F.col("pos")).alias("pos"), "feature",
        F.lit(False).alias("is_numeric"), F.lit(None).cast("double").alias("mean"),
        F.lit(None).cast("double").alias("scale"), mode["level"].alias("fill"))
    return num.unionByName(cat)


def linear(ledger: Ledger) -> tuple[DataFrame, DataFrame]:
    """(intercepts, terms) of every linear run."""
    art = ledger.artifacts().where("kind = 'linear_regression' and content is not null")
    m = art.select("run_id", F.from_json(
        "content", "intercept double, numeric array<array<string>>, categorical array<array<string>>").alias("m"))
    m = m.select("run_id", "m.*")
    num = m.select("run_id", F.explode("numeric").alias("t")).select(
        "run_id", F.col("t")[0].alias("feature"), F.lit(NO_LEVEL).alias("level"), F.col("t")[3].cast("double").alias("w"))
    cat = m.select("run_id", F.explode("categorical").alias("t")).select(
        "run_id", F.col("t")[0].alias("feature"),
        F.explode(F.from_json(F.col("t")[1], "array<array<string>>")).alias("p")).select(
        "run_id", "feature", F.col("p")[0].alias("level"), F.col("p")[1].cast("double").alias("w"))
    return m.select("run_id", "intercept"), num.unionByName(cat)


def nodes_path(ledger: Ledger) -> str:
    return os.path.join(ledger.root, "tree_nodes")


def tree_nodes(ledger: Ledger) -> DataFrame:
    """The node table of all tree runs (empty where there is none yet)."""
    spark = ledger.spark
    there = file_system(spark, nodes_path(ledger)).exists(hadoop_path(spark, nodes_path(ledger)))
    return spark.read.schema(NODES).parquet(nodes_path(ledger)) if there else spark.createDataFrame([], NODES)


def write_nodes(ledger: Ledger, run_id: str, model, path: str, numeric: Sequence[str], categorical: Sequence[str]) -> None:
    """Append the nodes of a saved tree pipeline to the node table (as many rows as the model has nodes)."""
    node_table(ledger.spark, run_id, model, path, numeric, categorical).coalesce(1).write.mode("append").parquet(
        nodes_path(ledger))


def node_table(spark: SparkSession, run_id: str, model, path: str, numeric: Sequence[str],
               categorical: Sequence[str]) -> DataFrame:
    """``NODES`` rows of a tree pipeline that was saved under ``path``."""
    slots: list[tuple[str, list[str] | None, bool]] = [(c, None, False) for c in numeric]
    labels = model.stages[0].labelsArray if categorical else []
    for c, known in zip(categorical, labels):  # one slot per level, and one for all others
        slots += [(c, [lv], False) for lv in known] + [(c, list(known), True)]
    saved = os.path.join(path, "stages", f"*_{model.stages[-1].uid}")
    weight = {r[0]: r[2] for r in spark.read.parquet(os.path.join(saved, "treesMetadata")).collect()}
    rows = spark.read.parquet(os.path.join(saved, "data")).select("treeID", "nodeData.*").collect()
    at = {(r["treeID"], r["id"]): r for r in rows}
    depth = {(t, 0): 0 for t in weight}
    out = []
    todo = list(depth)
    while todo:
        t, i = todo.pop()
        r = at[t, i]
        leaf = r["leftChild"] < 0
        feature, levels, negate, threshold, on_left = None, None, None, None, None
        if not leaf:
            feature, levels, negate = slots[r["split"]["featureIndex"]]
            side = r["split"]["leftCategoriesOrThreshold"]
            if levels is None:
                threshold = side[0]
            else:  # two values: 1 where the level holds; on the left are the listed ones, or those up to the threshold
                on_left = 1.0 in side if r["split"]["numCategories"] > 0 else side[0] >= 1.0
            for child in (r["leftChild"], r["rightChild"]):
                depth[t, child] = depth[t, i] + 1
                todo.append((t, child))
        out.append((run_id, t, float(weight[t]), i, depth[t, i], feature, threshold, levels, negate, on_left,
                    None if leaf else r["leftChild"], None if leaf else r["rightChild"],
                    r["prediction"] if leaf else None))
    return spark.createDataFrame(out, NODES)


# --- one row per run ---------------------------------------------------------------

def models(runs: DataFrame, cols: DataFrame, terms: DataFrame, nodes: DataFrame) -> DataFrame:
    """``runs`` with ``features`` (in order, each with its coefficients by level) and ``trees`` (in order, nodes by number)."""
    weights = terms.where("feature is not null and level is not null").dropDuplicates(["run_id", "feature", "level"])
    weights = weights.groupBy("run_id", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("level", "w"))).alias("w"))
    weights = weights.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("feature", "w"))).alias("weights"))
    described = cols.dropDuplicates(["feature_run_id", "pos"]).groupBy("feature_run_id").agg(F.array_sort(F.collect_list(
        F.struct("pos", "feature", "is_numeric", "mean", "scale", "fill"))).alias("features"))
    # Spark numbers the nodes of a tree 0, 1, 2, ...
    trees = nodes.groupBy("run_id", "tree").agg(F.first("weight").alias("weight"), F.array_sort(F.collect_list(F.struct(
        "node", "feature", "threshold", "levels", "negate", "on_left", "left", "right", "value"))).alias("nodes"))
    trees = trees.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("trees"))
    out = runs.join(weights, "run_id", "left").join(described, "feature_run_id", "left").join(trees, "run_id", "left")
    return out.withColumn("features", F.transform("features", lambda f: F.struct(
        *[f[c].alias(c) for c in ("pos", "feature", "is_numeric", "mean", "scale", "fill")],
        F.try_element_at("weights", f["feature"]).alias("w")))).drop("weights")


def _small_models(cols: DataFrame, terms: DataFrame, nodes: DataFrame) -> tuple[bool, bool]:
    """Whether no run's model has more than ``ROW_ENTRIES`` entries, and whether all have up to ``FEW_ROWS`` together."""
    per = (cols.select("feature_run_id").unionByName(terms.select(F.col("run_id").alias("feature_run_id")))
           .unionByName(nodes.select(F.col("run_id").alias("feature_run_id"))).groupBy("feature_run_id").count())
    largest, total = per.agg(F.max("count"), F.sum("count")).first()
    return (largest or 0) <= ROW_ENTRIES, (total or 0) <= FEW_ROWS


def _goes_left(node: Column, values: Column) -> Column:
    given = F.try_element_at(values, node["feature"])
    inside = F.array_contains(node["levels"], given) != node["negate"]
    return F.when(node["levels"].isNull(), given.try_cast("double") <= node["threshold"]).otherwise(inside == node["on_left"])


def grown(trees: Column, values: Column, deepest: int) -> Column:
    """The prediction of ``trees`` (as in ``models``): each is walked from its root, and the sum is taken in their order."""
    def leaf(tree):
        def step(at, _):
            node = F.get(tree["nodes"], at)
            return F.when(node["value"].isNotNull(), at).when(_goes_left(node, values), node["left"]).otherwise(node["right"])

        return F.get(tree["nodes"], F.aggregate(F.sequence(F.lit(0), F.lit(deepest)), F.lit(0), step))["value"]

    return F.aggregate(trees, F.lit(0.0), lambda a, t: a + t["weight"] * leaf(t))


# --- scoring --------------------------------------------------------------------

def walk(requests: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rid, y_pred) of requests (rid, run_id, values: feature to text) by the node table of their runs.

    One row per request and tree goes down one level per join; the sum over the trees is
    taken in their order, as the ensemble itself does.
    """
    deepest = nodes.agg(F.max("depth")).first()[0]
    if deepest is None:
        return requests.sparkSession.createDataFrame([], "rid bigint, y_pred double")
    nodes = _few(nodes)
    trees = nodes.where("node = 0").select("run_id", "tree", "weight")
    state = requests.join(trees, "run_id").withColumns({"node": F.lit(0), "leaf": F.lit(None).cast("double")})
    for level in range(deepest + 1):
        here = nodes.where(F.col("depth") == level).drop("weight", "depth")
        state = state.join(here, ["run_id", "tree", "node"], "left")
        given = F.try_element_at("values", "feature")
        inside = F.array_contains("levels", given) != F.col("negate")
        left = F.when(F.col("levels").isNull(), given.try_cast("double") <= F.col("threshold")).otherwise(
            inside == F.col("on_left"))
        state = state.select("rid", "run_id", "values", "tree", "weight",
                             F.coalesce("leaf", "value").alias("leaf"), F.when(left, F.col("left")).otherwise(F.col("right")).alias("node"))
    parts = F.array_sort(F.collect_list(F.struct("tree", (F.col("weight") * F.col("leaf")).alias("p"))))  # as many as trees
    total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x["p"])
    return state.groupBy("rid").agg(total.alias("y_pred"))


def score_requests(requests: DataFrame, run: Column, ledger: Ledger, keep: Sequence[str] = ()) -> DataFrame:
    """Impute-then-score every request with the training run that ``run`` names.

    Output: ``keep..., model_run_id, model_type, status, reason, used_features, imputed, y_pred``.
    Unknown runs and runs without a model give ``not_found``, text that is not a number ``bad_request``.
    """
    def text(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`").cast("string")
        return F.initcap(c) if isinstance(f.dataType, T.BooleanType) else c

    plain = [f for f in requests.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    values = F.map_from_entries(F.array(*[F.struct(F.lit(f.name), text(f)) for f in plain])) if plain else \
        F.create_map().cast("map<string,string>")
    req = requests.select(run.cast("string").alias("run_id"), values.alias("given"),
                          F.struct(F.lit(0).alias("_"), *keep).alias("keep"))

    cols, (intercepts, terms), nodes = features(ledger), linear(ledger), tree_nodes(ledger)
    runs = current_runs(ledger.runs()).select("run_id", "model_type", "feature_run_id")
    runs = runs.join(intercepts.dropDuplicates(["run_id"]), "run_id", "left").withColumn("known", F.lit(True))
    deepest = nodes.agg(F.max("depth")).first()[0]
    by_row, few = _small_models(cols, terms, nodes)
    if by_row:
        found = _by_row(req, models(runs, cols, terms, nodes), few)
    else:
        found = _by_joins(req.withColumn("rid", F.monotonically_increasing_id()), runs, cols, terms, nodes)

    def pair(f):  # "name":value, as in JSON
        s = F.when(f["is_numeric"], F.to_json(F.create_map(f["feature"], f["x"]))).otherwise(
            F.to_json(F.create_map(f["feature"], f["key"])))
        return F.substring(s, F.lit(2), F.length(s) - 2)

    bad = F.transform(F.filter("f", lambda f: f["bad"]), lambda f: f["feature"])
    per = found.select(
        *(["trees"] if by_row else ["rid"]), "run_id", "keep", "model_type", "reason", "intercept", bad.alias("bad"),
        F.concat(F.lit("{"), F.array_join(F.transform(F.filter("f", lambda f: ~f["bad"]), pair), ","), F.lit("}")).alias("used"),
        F.map_from_entries(F.transform(F.filter("f", lambda f: f["missing"]),
                                       lambda f: F.struct(f["feature"], f["fill"]))).alias("imputed"),
        F.aggregate("f", F.col("intercept"), lambda a, f: a + f["part"]).alias("linear"),
        F.map_from_entries(F.transform("f", lambda f: F.struct(f["feature"], F.when(
            f["is_numeric"], f["x"].cast("string")).otherwise(f["key"])))).alias("values"))
    ok = F.col("reason").isNull()
    fine = ok & (F.size("bad") == 0)
    climbs = fine & F.col("intercept").isNull()
    if deepest is None:
        per = per.withColumn("y_pred", F.lit(None).cast("double"))
    elif by_row:
        per = per.withColumn("y_pred", F.when(climbs, grown(F.col("trees"), F.col("values"), deepest)))
    else:
        per = _written(per)  # read twice from here on, so that the requests are scanned once
        per = per.join(walk(per.where(climbs).select("rid", "run_id", "values"), nodes), "rid", "left")
    out = per.select(
        "keep.*", F.col("run_id").alias("model_run_id"), F.when(ok, F.col("model_type")).alias("model_type"),
        F.when(fine, F.lit("ok")).when(ok, F.lit("bad_request")).otherwise(F.lit("not_found")).alias("status"),
        F.when(~ok, F.col("reason")).when(~fine, F.concat(F.lit("not a number: "), F.array_join("bad", ","))).alias("reason"),
        F.when(ok, F.col("used")).alias("used_features"), F.when(ok, F.col("imputed")).alias("imputed"),
        F.when(fine, F.coalesce("linear", "y_pred")).alias("y_pred")).drop("_")
    return _written(out) if by_row and deepest is not None else out  # trees are walked once, however often the rows are read


def _written(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "requests")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reason(model: str, described: str) -> Column:
    """Why a request has no prediction: null where the columns ``model`` (or an intercept) and ``described`` are there."""
    return (F.when(F.col("run_id").isNull(), F.lit("no finished training run"))
            .when(F.col("known").isNull(), F.concat(F.lit("Run "), "run_id", F.lit(" not found")))
            .when(F.col("intercept").isNull() & F.col(model).isNull(),
                  F.concat(F.lit("run "), "run_id", F.lit(" has no model")))
            .when(F.col(described).isNull(),
                  F.concat(F.lit("feature run "), "feature_run_id", F.lit(" has no feature model"))))


def _input(f, value: Column, weight) -> Column:
    """A feature of a request: its value or what stands in for it, and its part of the linear prediction."""
    missing = is_missing(value)
    x = F.when(f["is_numeric"], F.when(missing, f["mean"]).otherwise(to_double(value)))
    key = F.when(f["is_numeric"], F.lit(NO_LEVEL)).otherwise(F.when(missing, f["fill"]).otherwise(value))
    w = weight(key)
    part = F.when(f["is_numeric"], w * ((x - f["mean"]) / f["scale"])).otherwise(w)
    part = F.when(w.isNull(), F.lit(0.0)).otherwise(part)
    return F.struct(f["pos"].alias("pos"), f["feature"].alias("feature"), f["is_numeric"].alias("is_numeric"), x.alias("x"),
                    key.alias("key"), missing.alias("missing"), f["fill"].alias("fill"), part.alias("part"),
                    (f["is_numeric"] & x.isNull()).alias("bad"))


def _by_row(req: DataFrame, table: DataFrame, few: bool) -> DataFrame:
    """Requests with their run's row of ``models`` and their features ``f`` (null where there is a reason)."""
    found = req.join(F.broadcast(table) if few else table, "run_id", "left").withColumn("reason", _reason("trees", "features"))
    asked = F.when(F.col("reason").isNull(), F.col("features"))
    return found.withColumn("f", F.transform(asked, lambda f: _input(
        f, F.try_element_at("given", f["feature"]), lambda key: F.try_element_at(f["w"], key)))).drop("features", "given")


def _by_joins(req: DataFrame, runs: DataFrame, cols: DataFrame, terms: DataFrame, nodes: DataFrame) -> DataFrame:
    """The same for large models, by joins with their features and coefficients: requests go by ``rid``."""
    runs = runs.join(nodes.select("run_id").distinct().withColumn("walks", F.lit(True)), "run_id", "left").join(
        cols.select("feature_run_id").distinct().withColumn("described", F.lit(True)), "feature_run_id", "left")
    found = req.join(_few(runs), "run_id", "left").withColumn("reason", _reason("walks", "described"))
    asked = F.when(F.col("reason").isNull(), F.col("feature_run_id"))
    long = found.withColumn("asked", asked).join(
        _few(cols.withColumnRenamed("feature_run_id", "asked")), "asked", "left")
    value = F.try_element_at("given", "feature")
    level = F.when(is_missing(value), F.col("fill")).otherwise(value)
    long = long.withColumn("level", F.when(F.col("is_numeric"), F.lit(NO_LEVEL)).otherwise(level))
    long = long.join(_few(terms), ["run_id", "feature", "level"], "left")
    f = {c: F.col(c) for c in ("pos", "feature", "is_numeric", "mean", "scale", "fill")}
    one = F.when(F.col("feature").isNotNull(), _input(f, value, lambda key: F.col("w")))
    same = [F.first(c).alias(c) for c in ("run_id", "keep", "model_type", "reason", "intercept")]
    return long.groupBy("rid").agg(*same, F.array_sort(F.collect_list(one)).alias("f"))


def score_by_table(requests: DataFrame, run_col: str, models: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """C4 for models that a query made: ``models`` has run_id, intercept and a weight column per numeric feature.

    One join (broadcast below ``FEW_ROWS`` models), however many models there are; the
    requests' columns, ``status`` (``not_found`` for unknown models) and ``y_pred``.
    """
    table = models.select(F.col("run_id").cast("string").alias("_id"), F.col("intercept").alias("_b"),
                          *[F.col(c).alias(f"_w{i}") for i, c in enumerate(numeric)])
    out = requests.join(_few(table), F.col(run_col).cast("string") == F.col("_id"), "left")
    pred = F.col("_b")
    for i, c in enumerate(numeric):
        pred = pred + F.col(f"_w{i}") * requests[c].cast("double")
    return out.select(*requests.columns, F.when(F.col("_id").isNotNull(), F.lit("ok")).otherwise(
        F.lit("not_found")).alias("status"), F.when(F.col("_id").isNotNull(), pred).alias("y_pred"))

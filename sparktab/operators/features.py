"""Feature transforms (T1-T8) and record checks.

``fit_features`` runs one aggregate over the training rows (numeric statistics
and level counts together) and keeps the result as a small ``FeatureModel`` (size grows
with columns x levels, never with rows).  Every transform is then a plain
column expression, so scoring stays inside whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import BLANK, to_double
from .roles import Roles, feature_names
from .stats import NULL_LEVEL, level_key, training_stats

MAX_LEVELS = 1000  # high-cardinality guard for one-hot encoding


@dataclass
class FeatureModel:
    numeric: list[str]
    categorical: list[str]
    n_rows: int
    means: dict[str, float]
    stds: dict[str, float]          # sample std (ddof 1), recorded with the run
    std_pop: dict[str, float]       # population std (ddof 0), used for scaling
    levels: dict[str, dict[str, int]]
    target_mean: float | None = None
    extra: dict = field(default_factory=dict)

    # --- fitted metadata -------------------------------------------------
    def scale(self, c: str) -> float:
        s = self.std_pop[c]
        return s if s > 0 else 1.0  # zero variance: centre only

    def level_list(self, c: str) -> list[str]:
        return sorted(self.levels[c])

    @cached_property
    def fill(self) -> dict[str, float | str]:
        """What stands in for a missing value: training mean, or most frequent level (ties: the largest)."""
        values: dict[str, float | str] = dict(self.means)
        for c, counts in self.levels.items():
            top = max(counts.values(), default=None)
            values |= {c: max(lv for lv, n in counts.items() if n == top)} if counts else {}
        return values

    @property
    def feature_names(self) -> list[str]:
        return feature_names(self.numeric, {c: self.level_list(c) for c in self.categorical})

    def to_json(self) -> str:
        return json.dumps({
            "numeric": self.numeric, "categorical": self.categorical, "n_rows": self.n_rows,
            "feature_names": self.feature_names, "numeric_means": self.means,
            "numeric_stds": self.stds, "numeric_stds_pop": self.std_pop,
            "categorical_levels": self.levels, "target_mean": self.target_mean,
        }, sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> FeatureModel:
        d = json.loads(text)
        return cls(d["numeric"], d["categorical"], d["n_rows"], d["numeric_means"],
                   d["numeric_stds"], d["numeric_stds_pop"], d["categorical_levels"],
                   d.get("target_mean"))

    # --- column expressions ----------------------------------------------
    def standardized(self, c: str) -> Column:
        """``(x - mean) / std_pop``; a zero-variance column is only centred."""
        return (F.col(c).cast("double") - F.lit(self.means[c])) / F.lit(self.scale(c))

    def one_hot(self, c: str, df: DataFrame | None = None) -> list[Column]:
        """One 0/1 column per training level; unseen levels give all zeros."""
        key = level_key(df, c) if df is not None else F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL))
        return [F.when(key == F.lit(lv), F.lit(1.0)).otherwise(F.lit(0.0))
                .alias(f"categorical__{c}_{lv}") for lv in self.level_list(c)]

    def encoded_columns(self, df: DataFrame) -> list[Column]:
        """Numerics (table order) then one-hot blocks, with R2 names."""
        cols = [self.standardized(c).alias(f"numeric__{c}") for c in self.numeric]
        for c in self.categorical:
            cols.extend(self.one_hot(c, df))
        return cols

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """T4: apply the fitted encoding; ``keep`` columns ride along (keys, target)."""
        missing = [c for c in self.numeric + self.categorical if c not in df.columns]
        if missing:
            raise ValueError(f"input lacks column(s) {missing}")
        return df.select(*keep, *self.encoded_columns(df))


def fit_features(train: DataFrame, roles: Roles, target: str | None = None,
                 max_levels: int = MAX_LEVELS) -> FeatureModel:
    """Learn means/stds and level counts from the training rows (one aggregate)."""
    num_cols = list(roles.numeric) + ([target] if target else [])
    # one pass: numeric moments + all level counts; at most (features x max_levels) groups return
    bound = max(1, len(roles.categorical)) * max_levels
    ns, rows, n_rows = training_stats(train, num_cols, roles.categorical, bound)
    levels: dict[str, dict[str, int]] = {c: {} for c in roles.categorical}
    for feature, level, n in rows:
        levels[feature][level] = n
    wide = [c for c, lv in levels.items() if len(lv) > max_levels]
    if wide:
        raise ValueError(f"Categorical column(s) {wide} exceed {max_levels} levels; refusing to one-hot")
    return FeatureModel(
        numeric=list(roles.numeric), categorical=list(roles.categorical), n_rows=n_rows,
        means={c: float(ns[c]["mean"]) for c in roles.numeric},
        stds={c: float(ns[c]["std"]) for c in roles.numeric},
        std_pop={c: float(ns[c]["std_pop"]) for c in roles.numeric},
        levels=levels,
        target_mean=float(ns[target]["mean"]) if target else None,
    )


# --- P4 / P5 / T5 / T7 / T8 --------------------------------------------------

def is_missing(c: Column, dtype: T.DataType | None = None) -> Column:
    """Null, or text of white space only (any Unicode white space).  NaN is *not* missing.

    With a ``dtype`` other than string, the text test is left out.
    """
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.isNull()
    return c.isNull() | c.cast("string").rlike(BLANK)


def dummies(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """T5: ``c_level`` 0/1 columns replacing each listed column; null gives all zeros."""
    out = [F.col(c) for c in df.columns if c not in cols]
    for c in cols:
        for lv in sorted(levels[c]):
            out.append(F.coalesce((F.col(c).cast("string") == F.lit(lv)).cast("int"), F.lit(0))
                       .alias(f"{c}_{lv}"))
    return df.select(*out)


def dummy_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Distinct non-null levels per column via one aggregate (bounded by the guard)."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "feature", "level")
    bound = max(1, len(cols)) * max_levels
    rows = (long.filter(F.col("level").isNotNull()).groupBy("feature", "level").count()
            .limit(bound + 1).collect())
    out: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        out[r["feature"]].append(r["level"])
    wide = [c for c, v in out.items() if len(v) > max_levels]
    if wide or len(rows) > bound:
        raise ValueError(f"Column(s) {wide} exceed {max_levels} levels")
    return out


def impute(df: DataFrame, model: FeatureModel, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing numeric -> training mean, missing categorical -> training mode."""
    cols = list(cols) if cols is not None else model.numeric + model.categorical
    repl = {}
    for c in cols:
        v, dtype = _fill(model, c), df.schema[c].dataType
        missing = is_missing(F.col(c), dtype)
        if c in model.means:
            # text that is not a number becomes null here; callers flag it (bad_request)
            number = to_double(F.col(c)) if isinstance(dtype, T.StringType) else F.col(c).try_cast("double")
            repl[c] = F.when(missing, F.lit(float(v))).otherwise(number)
        else:
            text = F.col(c).cast("string")
            if isinstance(df.schema[c].dataType, T.BooleanType):
                text = F.initcap(text)  # same key as the training levels: True / False
            repl[c] = F.when(missing, F.lit(v)).otherwise(text)
    return df.withColumns(repl)


def _fill(model: FeatureModel, c: str):
    if c not in model.fill:
        raise ValueError(f"no training statistics for column {c!r}")
    return model.fill[c]


def imputed_map(model: FeatureModel, cols: Sequence[str] | None = None) -> Column:
    """``map<feature, imputed value as text>`` holding only the fields that were filled."""
    cols = list(cols) if cols is not None else model.numeric + model.categorical
    pairs = []
    for c in cols:
        v = _fill(model, c)  # numbers keep all their digits
        pairs += [F.lit(c), F.when(is_missing(F.col(c)), F.lit(repr(float(v)) if c in model.means else str(v)))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def missing_keys(features: Column, expected: Sequence[str]) -> Column:
    """P5: array of expected keys absent from a ``map<string,string>`` record."""
    return F.array_compact(F.array(*[
        F.when(~F.map_contains_key(features, F.lit(k)), F.lit(k)) for k in expected]))


def tag_records(records: DataFrame, features_col: str, numeric: Sequence[str],
                categorical: Sequence[str]) -> DataFrame:
    """P5 in one projection: typed features plus ``missing``, ``bad_cast`` and ``status``.

    Present keys with null values pass (as in the strict path); extra keys are
    ignored; numeric text that is not a number is flagged instead of raising.  A
    null record (text that was no JSON object) is rejected with every key missing
    and status ``malformed``.
    """
    m = F.col(features_col)
    expected = list(numeric) + list(categorical)
    bad_cast = F.array_compact(F.array(*[
        F.when(m[k].isNotNull() & to_double(m[k]).isNull(), F.lit(k)) for k in numeric]))
    others = [c for c in records.columns if c != features_col]
    tagged = records.select(*others, *[to_double(m[k]).alias(k) for k in numeric],
                            *[m[k].alias(k) for k in categorical],
                            m.isNull().alias("_malformed"),
                            F.when(m.isNull(), F.array(*[F.lit(k) for k in expected]).cast("array<string>"))
                            .otherwise(missing_keys(m, expected)).alias("missing"), bad_cast.alias("bad_cast"))
    ok = (F.size("missing") == 0) & (F.size("bad_cast") == 0)
    status = F.when(F.col("_malformed"), F.lit("malformed")).when(ok, F.lit("ok")).otherwise(F.lit("rejected"))
    return tagged.withColumn("status", status).drop("_malformed")


def align_records(records: DataFrame, features_col: str, numeric: Sequence[str],
                  categorical: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split map records into (aligned typed rows, rejects with the missing keys)."""
    tagged = tag_records(records, features_col, numeric, categorical)
    others = [c for c in records.columns if c != features_col]
    ok = tagged.where(F.col("status") == "ok").select(*others, *numeric, *categorical)
    rejects = tagged.where(F.col("status") != "ok").select(*others, "missing", "bad_cast", "status")
    return ok, rejects


def bad_numbers(model: FeatureModel, cols: Sequence[str] | None = None) -> Column:
    """Array of numeric features whose present value is not a number (ANSI-safe)."""
    cols = [c for c in (cols if cols is not None else model.numeric) if c in model.means]
    return F.array_compact(F.array(*[
        F.when(~is_missing(F.col(c)) & to_double(F.col(c)).isNull(), F.lit(c)) for c in cols]))

"""Feature role inference (R1) and encoded feature names (R2).

Roles come from the schema alone (no data pass): numeric types are numeric,
strings are categorical, booleans are categorical and listed after the strings.
Every other type is dropped from the features and reported, never silently.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]
    dropped: list[tuple[str, str]] = field(default_factory=list)  # (column, type)

    @property
    def features(self) -> list[str]:
        return self.numeric + self.categorical


def infer_roles(df: DataFrame, exclude: Iterable[str] = ()) -> Roles:
    skip = set(exclude)
    numeric, strings, bools, dropped = [], [], [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType):
            bools.append(f.name)
        elif isinstance(f.dataType, _NUMERIC):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            strings.append(f.name)
        else:
            dropped.append((f.name, f.dataType.simpleString()))
    if not numeric and not strings and not bools:
        raise ValueError("the schema has no numeric, text or boolean column to learn from")
    return Roles(numeric, strings + bools, dropped)


def feature_names(numeric: Sequence[str], levels: Mapping[str, Sequence[str]]) -> list[str]:
    """``numeric__c`` for numerics, ``categorical__c_level`` per sorted level."""
    names = [f"numeric__{c}" for c in numeric]
    for c, lv in levels.items():
        names.extend(f"categorical__{c}_{level}" for level in sorted(lv))
    return names

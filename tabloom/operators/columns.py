"""Column selection by name, type and group. Works on the schema; data is read only where stated."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import is_valid

# Feature groups and the name parts that place a column in them.
FEATURE_GROUPS = {
    "mfcc": ("mfcc",),
    "spectral": ("centroid", "bandwidth", "rolloff", "contrast", "flatness"),
    "rhythm": ("tempo", "beat", "rhythm"),
    "chroma": ("chroma",),
    "zcr": ("zcr",),
}


def find_columns(df: DataFrame, pattern: str) -> list[str]:
    """Every column whose name contains the pattern, ignoring case."""
    return [c for c in df.columns if pattern.lower() in c.lower()]


def find_column(df: DataFrame, pattern: str) -> str | None:
    """The first column whose name contains the pattern, or None."""
    return next(iter(find_columns(df, pattern)), None)


def select_by_pattern(df: DataFrame, *patterns: str) -> DataFrame:
    chosen = [c for c in df.columns if any(p.lower() in c.lower() for p in patterns)]
    return df.select(*chosen)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def numeric_features(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Keep numeric columns only; each other column that was not excluded is named in a warning."""
    keep = numeric_columns(df, exclude)
    for dropped in [c for c in df.columns if c not in keep and c not in set(exclude)]:
        warnings.warn(f"column {dropped} is not numeric and is left out", stacklevel=2)
    return df.select(*keep)


def valid_values(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose value is a number; an absent column gives no rows."""
    if column not in df.columns:
        return df.select(*keep, F.lit(None).cast("double").alias(column)).limit(0)
    return df.where(is_valid(column)).select(*keep, F.col(column).cast("double").alias(column))


def valid_categories(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose category is present, with their keys."""
    return df.where(F.col(column).isNotNull()).select(*keep, column)


def columns_with_values(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns that hold at least one number; one aggregation for all of them."""
    if not columns:
        return []
    row = df.agg(*[F.max(is_valid(c).cast("int")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    return [c for i, c in enumerate(columns) if row[f"_{i}"]]


def column_groups(df: DataFrame, patterns: Mapping[str, Sequence[str]] = FEATURE_GROUPS) -> dict[str, list[str]]:
    """Group name to column names; ``other`` holds the remaining numeric columns that have a value."""
    groups = {}
    for group, parts in patterns.items():
        found = [c for p in parts for c in find_columns(df, p)]
        if found:
            groups[group] = list(dict.fromkeys(found))
    covered = {c for found in groups.values() for c in found}
    other = columns_with_values(df, [c for c in numeric_columns(df) if c not in covered])
    if other:
        groups["other"] = other
    return groups


def integers_to_double(df: DataFrame) -> DataFrame:
    """Discrete numbers become continuous; all other columns keep their type."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.IntegralType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )

"""Delimited files with several header rows, headerless files, and the results sink.

The header rows are read on the driver (a few lines of one file); the body is read by Spark
with an explicit schema, so unwanted columns are never parsed into rows and files split
across tasks. A large data set may keep its header rows in a file of their own
(``header_path``) next to a folder of body files.
"""

from __future__ import annotations

import csv
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.expressions import MISSING_TOKENS, missing_to_null
from tabloom.operators.joins import join_on_key


@dataclass(frozen=True)
class HeaderLayout:
    """How many header rows there are, which of them name a column, and the key column's name."""

    rows: int
    name_rows: tuple[int, ...]
    key: str = "track_id"


# The two known layouts. Tracks: group and name rows, then a row naming the key.
# Features: group, statistic and component rows, then a row naming the key.
TRACKS_LAYOUT = HeaderLayout(rows=3, name_rows=(0, 1))
FEATURES_LAYOUT = HeaderLayout(rows=4, name_rows=(0, 1, 2))
THREE_ROW_LAYOUT = HeaderLayout(rows=3, name_rows=(0, 1, 2))


def require_path(spark: SparkSession, path: str) -> None:
    """Raise with the path in the message when nothing is there."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no data at {path}") from error


def header_rows(spark: SparkSession, path: str, count: int, separator: str = ",") -> list[list[str]]:
    """The first lines of one file, split with quotes honoured."""
    require_path(spark, path)
    lines = [r["value"] for r in spark.read.text(path).head(count)]
    return [[cell.strip() for cell in row] for row in csv.reader(lines, delimiter=separator)]


def column_names(header: Sequence[Sequence[str]], layout: HeaderLayout) -> list[str]:
    """Header cells joined by underscores; a repeated name gets a numeric suffix."""
    width = max(len(row) for row in header)
    padded = [list(row) + [""] * (width - len(row)) for row in header]
    names: list[str] = []
    seen: dict[str, int] = {}
    for i in range(width):
        if i == 0:
            name = layout.key
        else:
            name = "_".join(padded[r][i] for r in layout.name_rows if padded[r][i]) or f"column_{i}"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name] - 1}")
    return names


def _typed(cell: Column, kind: str) -> Column:
    """A text cell in its type; the missing tokens and, for numbers, unparsable cells become null."""
    known = missing_to_null(cell)
    return known if kind == "string" else known.try_cast(kind)


def _key(cell: Column, name: str, kind: str) -> Column:
    """The key in its type; a key that is there but does not parse is an error."""
    if kind == "string":
        return cell
    parsed = cell.try_cast(kind)
    message = F.concat(F.lit(f"{name} does not parse as {kind}: "), cell)
    return F.when(cell.isNotNull() & parsed.isNull(), F.raise_error(message).cast(kind)).otherwise(parsed)


def read_multi_header(
    spark: SparkSession,
    path: str,
    layout: HeaderLayout,
    wanted: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    default_type: str = "string",
    key_type: str = "string",
    header_path: str | None = None,
    separator: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """Read a delimited file below its header rows, keeping the key and the wanted columns.

    Every line becomes a row but the header lines, which are known by their cells (those of the
    columns read) wherever a file or split starts, and the line that holds nothing but the key's
    name. The key is text unless ``key_type`` says otherwise. ``types`` maps a column name to its
    type; unparsable cells and the missing tokens become null.
    """
    header = header_rows(spark, header_path or path, layout.rows, separator)
    names = column_names(header[: max(layout.name_rows) + 1], layout)
    types = dict(types or {})
    require_path(spark, path)
    reader = spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("sep", separator)
    body = reader.option("header", False).option("mode", "PERMISSIVE").option("multiLine", multi_line).csv(path)
    chosen = [n for n in (wanted if wanted is not None else names) if n != layout.key]
    place = {n: i for i, n in enumerate(names)}
    read = [layout.key, *chosen]

    def cell(name: str) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`"), F.lit("")))

    def same(texts: Sequence[str]) -> Column:
        found = F.lit(True)
        for name, text in zip(read, texts):
            found = found & (cell(name) == F.lit(text))
        return found

    headers = [[(row[place[n]] if place[n] < len(row) else "") for n in read] for row in header]
    headers.append([layout.key] + [""] * len(chosen))
    is_header = F.lit(False)
    for texts in dict.fromkeys(map(tuple, headers)):
        if any(texts):
            is_header = is_header | same(texts)
    columns = [_typed(F.col(f"`{n}`"), types.get(n, default_type)).alias(n) for n in chosen]
    return body.where(~is_header).select(_key(F.col(f"`{layout.key}`"), layout.key, key_type).alias(layout.key), *columns)


def infer_types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Types of text columns from one pass: bigint, double or string."""
    checks = [
        f
        for c in columns
        for f in (
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("bigint").isNull()).alias(f"i_{c}"),
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"d_{c}"),
            F.count(c).alias(f"n_{c}"),
        )
    ]
    row = df.agg(*checks).first()
    found = {}
    for c in columns:
        if row[f"n_{c}"] == 0 or row[f"d_{c}"] > 0:
            found[c] = "string"
        else:
            found[c] = "bigint" if row[f"i_{c}"] == 0 else "double"
    return found


def read_tracks(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    group: str = "track",
    types: Mapping[str, str] | None = None,
    layout: HeaderLayout = TRACKS_LAYOUT,
    **options,
) -> DataFrame:
    """Key and the columns of one header group, named ``<group>_<name>``.

    ``columns`` picks names within the group; an unknown name is warned about and skipped.
    Without ``types`` they are inferred from the wanted columns in one pass.
    """
    header = header_rows(spark, options.get("header_path") or path, layout.rows, options.get("separator", ","))
    names = column_names(header[: max(layout.name_rows) + 1], layout)
    inside = [n for i, n in enumerate(names) if i > 0 and i < len(header[0]) and header[0][i] == group]
    wanted = inside
    if columns is not None:
        wanted = []
        for c in columns:
            if f"{group}_{c}" in inside:
                wanted.append(f"{group}_{c}")
            else:
                warnings.warn(f"column {c} is not in group {group} and is skipped", stacklevel=2)
    if types is None:
        text = read_multi_header(spark, path, layout, wanted, **options)
        types = infer_types(text, wanted) if wanted else {}
    return read_multi_header(spark, path, layout, wanted, types, **options)


def read_features(
    spark: SparkSession,
    path: str,
    groups: Sequence[str] | None = None,
    layout: HeaderLayout = FEATURES_LAYOUT,
    **options,
) -> DataFrame:
    """Key and numeric columns of the wanted header groups; an unknown group raises."""
    header = header_rows(spark, options.get("header_path") or path, layout.rows, options.get("separator", ","))
    names = column_names(header[: max(layout.name_rows) + 1], layout)
    present = {cell for cell in header[0][1:] if cell}
    unknown = sorted(set(groups or ()) - present)
    if unknown:
        raise ValueError(f"unknown feature groups: {', '.join(unknown)}")
    wanted = [n for i, n in enumerate(names) if i > 0 and i < len(header[0]) and (groups is None or header[0][i] in groups)]
    return read_multi_header(spark, path, layout, wanted, default_type="double", **options)


def read_tracks_and_features(
    spark: SparkSession,
    tracks_path: str,
    features_path: str,
    columns: Sequence[str] | None = None,
    groups: Sequence[str] | None = None,
    tracks_options: Mapping | None = None,
    features_options: Mapping | None = None,
) -> DataFrame:
    """Both tables with their projections, joined on the key as text."""
    tracks = read_tracks(spark, tracks_path, columns, **(tracks_options or {}))
    features = read_features(spark, features_path, groups, **(features_options or {}))
    return join_on_key(tracks, features, "track_id")


def read_datasets(
    spark: SparkSession,
    tracks_path: str,
    features_path: str,
    layout: HeaderLayout = THREE_ROW_LAYOUT,
    tracks_options: Mapping | None = None,
    features_options: Mapping | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both tables whole, named by their joined header rows, for exploration."""
    tracks = read_multi_header(spark, tracks_path, layout, **(tracks_options or {}))
    kinds = infer_types(tracks, [c for c in tracks.columns if c != layout.key])
    typed = read_multi_header(spark, tracks_path, layout, types=kinds, **(tracks_options or {}))
    features = read_multi_header(spark, features_path, layout, default_type="double", **(features_options or {}))
    return typed, features


def read_headerless(
    spark: SparkSession, path: str, columns: int, label_type: str = "string", separator: str = ","
) -> DataFrame:
    """``columns - 1`` numbers and a label per line, named ``_c0``, ``_c1`` and so on; blank lines are skipped."""
    require_path(spark, path)
    fields = [f"_c{i} double" for i in range(columns - 1)] + [f"_c{columns - 1} {label_type}"]
    rows = spark.read.schema(", ".join(fields)).option("sep", separator).csv(path)
    blank = F.lit(True)
    for c in rows.columns:
        blank = blank & F.col(c).isNull()
    return rows.where(~blank)


def boolean_label(df: DataFrame, column: str, value: str, name: str) -> DataFrame:
    """A Boolean column that tells whether a text column equals a value."""
    return df.withColumn(name, F.col(column) == F.lit(value))


def write_results(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Write a results table; nested columns (the confusion matrix) become JSON text in CSV."""
    if kind == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        df = df.withColumns({c: F.to_json(c) for c in nested}) if nested else df
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif kind == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError("kind must be csv or parquet")


def read_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read a results table back; the matrix column is parsed from its JSON text."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


__all__ = [
    "FEATURES_LAYOUT",
    "MISSING_TOKENS",
    "THREE_ROW_LAYOUT",
    "TRACKS_LAYOUT",
    "HeaderLayout",
    "boolean_label",
    "column_names",
    "header_rows",
    "infer_types",
    "read_datasets",
    "read_features",
    "read_headerless",
    "read_multi_header",
    "read_results",
    "read_tracks",
    "read_tracks_and_features",
    "require_path",
    "write_results",
]

"""Helpers that the operators share: written tables, small driver-made tables, text spans."""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: later jobs neither repeat nor depend on its lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows while the block runs its jobs, so long texts fit in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_table(spark: SparkSession, rows: Sequence[dict], schema: str) -> DataFrame:
    """A bounded table made on the driver, as one JSON literal that Spark expands."""
    parsed = F.from_json(F.lit(json.dumps(list(rows))), f"array<struct<{schema}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def row_key(doc_id: Column, text: Column) -> Column:
    """Rows with the same key hold the same id and text, so whatever follows from the text is the same."""
    return F.struct(doc_id.alias("id"), F.xxhash64(text).alias("hash"))


def bytes_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the fast way."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def spans(text: Column, pattern: str, gate: Column | None = None, around: int = 0) -> Column:
    """Leftmost non-overlapping matches of a Java pattern that never matches the empty text.

    An array of structs: start and end (code points, end exclusive), match, and with ``around`` the
    characters before and after. Split gives the gaps between matches, so positions are running sums.
    ``gate`` is a cheap necessary condition; texts that miss it are not searched.
    """
    near = "before string, after string" if around else ""
    kind = f"array<struct<start: int, end: int, match: string{', ' + near if near else ''}>>"
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("match"), F.slice(gaps, 2, F.size(gaps)).alias("rest"))

    def step(state: Column, item: Column) -> Column:
        start = state["at"] + F.char_length(item["gap"])
        end = start + F.char_length(item["match"])
        fields = [start.alias("start"), end.alias("end"), item["match"].alias("match")]
        if around:
            fields += [F.right(item["gap"], F.lit(around)).alias("before"), F.left(item["rest"], F.lit(around)).alias("after")]
        return F.struct(end.alias("at"), F.array_append(state["out"], F.struct(*fields)).alias("out"))

    empty = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    pairs = F.filter(zipped, lambda z: z["match"].isNotNull())
    value = F.aggregate(pairs, empty, step, lambda s: s["out"])
    wanted = text.rlike(pattern) if gate is None else gate & text.rlike(pattern)
    return F.when(wanted, value).otherwise(F.array().cast(kind))


def digest(items: Column) -> Column:
    """``kind:start:end`` of every struct, comma-joined."""
    return F.array_join(
        F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )

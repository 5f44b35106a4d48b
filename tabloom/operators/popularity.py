"""Popularity reports: which metrics exist, how they are distributed and what they depend on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import is_valid, log_popularity, valid_or_null
from tabloom.operators.columns import columns_with_values, find_column
from tabloom.operators.profile import histogram
from tabloom.operators.splits import sample_rows

# Name parts of popularity metrics, the first one found is the primary metric.
POPULARITY_PATTERNS = ("listens", "favorites", "comments", "interest")
# Duration limits in seconds.
DURATION_RANGE = (30.0, 600.0)
MINUTE_BINS = (60, 360)


def popularity_metrics(df: DataFrame, patterns: Sequence[str] = POPULARITY_PATTERNS) -> dict[str, str]:
    """Pattern to its first column, for columns that hold at least one number."""
    named = {p: find_column(df, p) for p in patterns}
    named = {p: c for p, c in named.items() if c is not None}
    with_values = set(columns_with_values(df, list(dict.fromkeys(named.values()))))
    return {p: c for p, c in named.items() if c in with_values}


def popularity_histogram(df: DataFrame, column: str, bins: int = 50, min_rows: int = 100) -> DataFrame:
    """Histogram of log10(v + 1); empty unless more than ``min_rows`` values are valid."""
    logs = df.where(is_valid(column)).select(log_popularity(column).alias("_l"))
    return histogram(logs, "_l", bins, min_rows=min_rows)


def popularity_by_category(
    df: DataFrame, category: str, column: str, min_rows: int = 20, min_count: int = 20, top: int = 10
) -> DataFrame:
    """Mean popularity of the categories with enough rows, highest first.

    Empty when fewer than ``min_rows`` rows have both values.
    """
    pairs = df.where(F.col(category).isNotNull() & is_valid(column))
    groups = pairs.groupBy(category).agg(F.avg(F.col(column).cast("double")).alias("mean_popularity"), F.count("*").alias("n"))
    result = groups.where(F.col("n") >= min_count)
    if min_rows > min_count:
        # with at least one full group the row gate already holds unless it asks for more
        result = result.where(groups.agg(F.sum("n") >= min_rows).scalar())
    return result.orderBy(F.desc("mean_popularity"), category).limit(top)


def _usable(df: DataFrame, duration: str, column: str) -> DataFrame:
    low, high = DURATION_RANGE
    d = F.col(duration).cast("double")
    inside = (d > low) & (d < high) & (F.col(column) > 0)
    return df.where(is_valid(duration) & is_valid(column) & inside)


def duration_popularity_points(
    df: DataFrame,
    key: str,
    duration: str,
    column: str,
    sample: int | None = 2000,
    seed: int = 0,
    min_rows: int = 100,
    min_usable: int = 50,
) -> DataFrame:
    """Scatter points (duration, log10(popularity + 1)) of a reproducible row sample."""
    counts = df.agg(
        F.count_if(is_valid(duration) & is_valid(column)).alias("valid"),
        F.count_if(
            is_valid(duration)
            & is_valid(column)
            & (F.col(duration) > DURATION_RANGE[0])
            & (F.col(duration) < DURATION_RANGE[1])
            & (F.col(column) > 0)
        ).alias("usable"),
    ).first()
    rows = _usable(df, duration, column)
    if counts["valid"] < min_rows or counts["usable"] <= min_usable:
        rows = rows.limit(0)
    elif sample is not None:
        rows = sample_rows(rows, key, sample, seed)
    return rows.select(
        key, F.col(duration).cast("double").alias("duration"), log_popularity(column).alias("log_popularity")
    )


def popularity_by_minutes(
    df: DataFrame,
    duration: str,
    column: str,
    min_count: int = 10,
    min_rows: int = 100,
    min_usable: int = 50,
) -> DataFrame:
    """Mean popularity per whole-minute duration bin between one and six minutes.

    Computed over all usable rows; bins with at most ``min_count`` rows are left out.
    """
    first, last = MINUTE_BINS
    d = F.col(duration).cast("double")
    usable = F.coalesce((d > DURATION_RANGE[0]) & (d < DURATION_RANGE[1]) & (F.col(column) > 0), F.lit(False))
    minute = F.when(usable & (d >= first) & (d < last), F.floor(d / 60)).cast("int")
    binned = (
        df.where(is_valid(duration) & is_valid(column))
        .select(minute.alias("_minute"), usable.alias("_usable"), valid_or_null(column).alias("_p"))
        .groupBy("_minute", "_usable")
        .agg(F.max("_minute").alias("minute"), F.avg("_p").alias("mean_popularity"), F.count("*").alias("n"))
    )
    # filtering by an aggregate's value keeps the gate on the same shuffled counts: one scan
    gate = binned.agg(
        (F.sum("n") >= min_rows) & (F.sum(F.when(F.col("_usable"), F.col("n"))) > min_usable)
    ).scalar()
    label = F.concat(F.col("minute").cast("string"), F.lit("-"), (F.col("minute") + 1).cast("string"), F.lit("min"))
    kept = binned.where(F.col("minute").isNotNull() & (F.col("n") > min_count) & gate)
    return kept.select("minute", label.alias("duration_bin"), "mean_popularity", "n").orderBy("minute")


def popularity_report(
    df: DataFrame, key: str, category: str | None = None, duration: str | None = None, metric: str | None = None
) -> dict[str, DataFrame]:
    """Every popularity table that the columns allow; the primary metric is the first pattern found."""
    metrics = popularity_metrics(df)
    if not metrics:
        return {}
    report = {f"histogram_{p}": popularity_histogram(df, c) for p, c in metrics.items()}
    primary = metric or next(iter(metrics.values()))
    category = category or find_column(df, "genre_top")
    duration = duration or find_column(df, "duration")
    if category is not None:
        report["by_category"] = popularity_by_category(df, category, primary)
    if duration is not None:
        report["points"] = duration_popularity_points(df, key, duration, primary)
        report["by_minutes"] = popularity_by_minutes(df, duration, primary)
    return report

"""Data quality, dates, categories, summaries, histograms, boxes and correlations as tables.

Each report makes as few passes as its definition allows: statistics of many columns share one
aggregation, and totals enter as scalar subqueries instead of joins.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.blocks import summed
from tabloom.functions.expressions import (
    as_column,
    equal_width_bin,
    is_valid,
    parse_date,
    valid_or_null,
)
from tabloom.operators.columns import find_column, find_columns, numeric_columns
from tabloom.operators.quantiles import column_quantiles, exact_quantiles, null_safe_join
from tabloom.operators.scaling import sample_columns
from tabloom.session import keep, stored

# Name parts of representative features.
SPECTRAL_SAMPLE = ("centroid", "bandwidth", "rolloff", "contrast")
COMPARED_FEATURES = ("mfcc_mean", "centroid_mean", "bandwidth_mean", "zcr")


# --- quality -------------------------------------------------------------------------------


def missing_report(df: DataFrame, top: int | None = 10) -> DataFrame:
    """Columns with missing values: ``column_name, n_missing, pct_missing, n_rows``, most first; NaN is missing."""
    names = df.columns

    def missing(c: str) -> Column:
        floating = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        return F.col(c).isNull() | F.isnan(c) if floating else F.col(c).isNull()

    counted = df.agg(F.count("*").alias("n_rows"), *[F.count_if(missing(c)).alias(f"n_missing_{i}") for i, c in enumerate(names)])
    items = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(f"n_missing_{i}").alias("n_missing")) for i, c in enumerate(names)]
    )
    rows = counted.select("n_rows", F.explode(items).alias("_r")).select("_r.*", "n_rows")
    share = F.round(F.lit(100.0) * F.col("n_missing") / F.col("n_rows"), 2)
    found = rows.where("n_missing > 0").select("column_name", "n_missing", share.alias("pct_missing"), "n_rows")
    ordered = found.orderBy(F.desc("n_missing"), "column_name")
    return ordered.limit(top) if top is not None else ordered


def type_report(df: DataFrame) -> DataFrame:
    """Number of columns per type; schema only."""
    counts: dict[str, int] = {}
    for field in df.schema.fields:
        counts[field.dataType.simpleString()] = counts.get(field.dataType.simpleString(), 0) + 1
    return df.sparkSession.createDataFrame(
        sorted(counts.items(), key=lambda x: (-x[1], x[0])), "data_type string, n_columns int"
    )


def quality_report(df: DataFrame, top: int = 10) -> dict[str, DataFrame]:
    """Size, missing values and types of a table."""
    size = df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
    return {"size": size, "missing": missing_report(df, top), "types": type_report(df)}


# --- dates ---------------------------------------------------------------------------------


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Earliest, latest and number of present dates."""
    return df.agg(
        F.min(column).alias("earliest"), F.max(column).alias("latest"), F.count(column).alias("n_dates")
    )


def yearly_counts(df: DataFrame, column: str, min_rows: int = 100, min_years: int = 2) -> DataFrame:
    """Rows per year, ascending; text is parsed by the known layouts and unparsable rows are left out.

    Empty unless there are more than ``min_rows`` present values and at least ``min_years`` years.
    """
    kind = df.schema[column].dataType
    day = parse_date(column) if isinstance(kind, T.StringType) else F.col(column).cast("date")
    # null years are dropped by an aggregate's value, a filter that cannot sink below the grouping:
    # the gate then reads the same shuffled counts and the table is scanned once
    years = (
        df.where(F.col(column).isNotNull())
        .select(F.year(day).alias("_year"))
        .groupBy("_year")
        .agg(F.max("_year").alias("year"), F.count("*").alias("n"))
    )
    gates = years.agg(F.sum("n").alias("rows"), F.count("year").alias("years"))
    open_ = gates.select((F.col("rows") > min_rows) & (F.col("years") >= min_years)).scalar()
    return years.where(F.col("year").isNotNull() & open_).select("year", "n").orderBy("year")


def temporal_report(df: DataFrame, created: str = "track_date_created") -> dict[str, DataFrame]:
    """Date columns, range and yearly counts of the creation date."""
    spark = df.sparkSession
    report = {"columns": spark.createDataFrame([(c,) for c in find_columns(df, "date")], "column_name string")}
    column = find_column(df, created)
    if column is not None:
        report["range"] = date_range(df, column)
        report["yearly"] = yearly_counts(df, column)
    return report


# --- categories ----------------------------------------------------------------------------


def category_distribution(df: DataFrame, column: str, top: int | None = 15) -> DataFrame:
    """Most frequent categories with their share of all present values."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    ranked = counts.withColumn("pct", F.lit(100.0) * F.col("n") / total).orderBy(F.desc("n"), column)
    return ranked.limit(top) if top is not None else ranked


# --- numeric summaries ---------------------------------------------------------------------


def duration_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, moments, quartiles and totals of positive durations in seconds."""
    positive = df.where(is_valid(column) & (F.col(column) > 0)).select(F.col(column).cast("double").alias("_d"))
    q = exact_quantiles(positive, "_d", (0.25, 0.5, 0.75)).select("q").scalar()
    return positive.agg(
        F.count("_d").alias("n"),
        F.avg("_d").alias("mean"),
        F.stddev_samp("_d").alias("std"),
        F.min("_d").alias("min"),
        F.max("_d").alias("max"),
        (F.sum("_d") / 3600).alias("total_hours"),
        (F.sum("_d") / 86400).alias("total_days"),
    ).select("n", "mean", q[1].alias("median"), "std", "min", "max", q[0].alias("p25"), q[2].alias("p75"), "total_hours", "total_days")


def feature_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, deviation, range, median, skewness and excess kurtosis per column.

    Population moments, as in the usual definitions without bias correction. Moments of all
    columns come from one aggregation; medians follow the exact-quantile operator.
    """
    fields = {
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "skewness": F.skewness,
        "kurtosis": F.kurtosis,
    }
    values = df.select(*[valid_or_null(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    wide = values.agg(*[f(f"_c{i}").alias(f"{k}_{i}") for k, f in fields.items() for i in range(len(columns))])
    medians = column_quantiles(values, values.columns, (0.5,))
    rows = wide.first()
    table = [
        (c, *[None if rows[f"{k}_{i}"] is None else float(rows[f"{k}_{i}"]) for k in fields], medians[f"_c{i}"][0])
        for i, c in enumerate(columns)
    ]
    schema = f"feature string, {', '.join(f'{k} double' for k in fields)}, median double"
    return df.sparkSession.createDataFrame(table, schema).select(
        "feature", "mean", "std", "min", "max", "median", "skewness", "kurtosis"
    )


def group_statistics(df: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """``feature_statistics`` of every numeric column of the groups, tagged with the group."""
    numeric = set(numeric_columns(df))
    member = [(g, c) for g, columns in groups.items() for c in columns if c in numeric]
    tags = df.sparkSession.createDataFrame(member, "group string, feature string")
    return tags.join(feature_statistics(df, sorted({c for _, c in member})), "feature").select(
        "group", "feature", "mean", "std", "min", "max", "median", "skewness", "kurtosis"
    )


def group_ranges(statistics: DataFrame) -> DataFrame:
    """Range of means and deviations per group; input is the small table of ``group_statistics``."""
    return statistics.groupBy("group").agg(
        F.count("*").alias("n_features"),
        F.min("mean").alias("mean_low"),
        F.max("mean").alias("mean_high"),
        F.min("std").alias("std_low"),
        F.max("std").alias("std_high"),
    )


# --- histograms and boxes ------------------------------------------------------------------


def histogram(
    df: DataFrame, column: Column | str, bins: int = 50, below: float | None = None, min_rows: int = 0
) -> DataFrame:
    """Equal-width bins over the range of valid values: ``bin, low, high, n``; empty bins are absent.

    With ``min_rows`` there are no bins at all unless more values than that are valid.
    """
    rows = df.select(valid_or_null(as_column(column)).alias("_v")).where("_v is not null")
    if below is not None:
        rows = rows.where(F.col("_v") < F.lit(float(below)))
    span = rows.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("_v").alias("n"))).scalar()
    lo, hi = span["lo"], span["hi"]
    counted = rows.groupBy(equal_width_bin("_v", lo, hi, bins).alias("bin")).agg(F.count("*").alias("n"))
    width = (hi - lo) / F.lit(float(bins))
    if min_rows:
        counted = counted.where(span["n"] > min_rows)
    return counted.select(
        "bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"), "n"
    )


def histograms(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """``histogram`` of several columns together: one pass for the ranges, one for the counts."""
    values = df.select(*[valid_or_null(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    spans = values.agg(
        *[f(f"_c{i}").alias(f"{k}_{i}") for k, f in (("lo", F.min), ("hi", F.max)) for i in range(len(columns))]
    ).first()
    known = [(i, c) for i, c in enumerate(columns) if spans[f"lo_{i}"] is not None]
    if not known:
        return df.sparkSession.createDataFrame([], "feature string, bin int, low double, high double, n bigint")
    items = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.lit(spans[f"lo_{i}"]).alias("lo"),
                F.lit(spans[f"hi_{i}"]).alias("hi"),
                F.col(f"_c{i}").alias("v"),
            )
            for i, c in known
        ]
    )
    long = values.select(F.explode(items).alias("_r")).select("_r.*").where("v is not null")
    binned = equal_width_bin("v", F.col("lo"), F.col("hi"), bins).alias("bin")
    counted = long.groupBy("feature", "lo", "hi", binned).agg(F.count("*").alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return counted.select(
        "feature",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        "n",
    )


def feature_distributions(df: DataFrame, bins: int = 50) -> DataFrame:
    """Histograms of the first twelve cepstral means and the first mean of four spectral features."""
    chosen = [c for c in find_columns(df, "mfcc") if "mean" in c.lower()][:12]
    for part in SPECTRAL_SAMPLE:
        chosen += [c for c in find_columns(df, part) if "mean" in c.lower()][:1]
    return histograms(df, list(dict.fromkeys(chosen)), bins)


def box_summary(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), below: float | None = None, whisker: float = 1.5
) -> DataFrame:
    """Box-plot numbers per column and group: quartiles, whiskers inside the fences, outliers.

    Whiskers are the extreme values no further than ``whisker`` interquartile ranges from the box.
    """
    items = F.array(*[F.struct(F.lit(c).alias("feature"), valid_or_null(c).alias("v")) for c in columns])
    long = df.select(*by, F.explode(items).alias("_r")).select(*by, "_r.feature", "_r.v").where("v is not null")
    if below is not None:
        long = long.where(F.col("v") < F.lit(float(below)))
    keys = [*by, "feature"]
    quartiles = exact_quantiles(long, "v", (0.25, 0.5, 0.75), by=keys).select(
        *keys, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )
    reach = F.lit(float(whisker)) * (F.col("q3") - F.col("q1"))
    # one row per group, whose stored size tells the planner how to join
    fenced = quartiles.withColumns({"_lo": F.col("q1") - reach, "_hi": F.col("q3") + reach})
    inside = F.col("v").between(F.col("_lo"), F.col("_hi"))
    return (
        null_safe_join(long, fenced, keys)
        .groupBy(*keys, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .select(*keys, "n", "whisker_low", "q1", "median", "q3", "whisker_high", "n_outliers")
    )


def top_categories(df: DataFrame, column: str, top: int = 8) -> DataFrame:
    """The most frequent categories; at most ``top`` rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(top).select(column)


def compared_features(df: DataFrame, patterns: Sequence[str] = COMPARED_FEATURES, most: int = 4) -> list[str]:
    """First column per pattern; without any match the first columns with ``mean`` in the name."""
    found = [c for c in (find_column(df, p) for p in patterns) if c is not None]
    return (found or find_columns(df, "mean"))[:most]


def feature_by_category(df: DataFrame, category: str, features: Sequence[str] | None = None, top: int = 8) -> DataFrame:
    """Box numbers of features within the ``top`` categories; empty with a single category."""
    features = list(features) if features is not None else compared_features(df)
    df = keep(df.select(category, *features))
    leaders = [r[0] for r in top_categories(df, category, top).collect()]
    if len(leaders) < 2:
        leaders = []
    chosen = df.where(F.col(category).isin(leaders) if leaders else F.lit(False))
    boxes = stored(box_summary(chosen, features, by=(category,)), "boxes")
    df.unpersist()
    return boxes


# --- correlation ---------------------------------------------------------------------------


COLUMN_BLOCK = 64  # columns that are multiplied with as many others at a time
PRODUCTS = 4_000_000  # sums of products that a task holds; more columns take more scans


def correlation_pairs(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    above: float = 0.8,
    top: int | None = 10,
    max_columns: int | None = None,
    separator: str = "_",
    distinct_suffix: bool = True,
    seed: int = 0,
) -> DataFrame:
    """Pairs of columns with a strong Pearson correlation, strongest first.

    Missing values count as column means. Pairs whose last name token is equal are left out when
    ``distinct_suffix`` is set. Columns are multiplied in blocks: tasks add up the products of their rows, the sums
    of two blocks meet in one task, and only pairs above the threshold leave it. The driver sees two numbers a column.
    """
    columns = list(columns) if columns is not None else numeric_columns(df)
    if max_columns is not None:
        columns = sample_columns(columns, max_columns, seed)
    width = len(columns)
    schema = "feature1 string, feature2 string, correlation double"
    if width < 2:
        return df.sparkSession.createDataFrame([], schema)
    data = keep(df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x")))

    def matrix(batch):
        return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)

    def add_sums(total, batch):
        import numpy

        x = matrix(batch)
        total[:width] += numpy.nansum(x, axis=0)
        total[width:] += (~numpy.isnan(x)).sum(axis=0)

    sums = summed(data, add_sums, 2 * width)
    means = sums[:width] / np.maximum(sums[width:], 1)

    def centred(batch):
        import numpy

        return numpy.nan_to_num(matrix(batch) - means, nan=0.0)

    def add_squares(total, batch):
        total += (centred(batch) ** 2).sum(axis=0)

    scale = np.sqrt(summed(data, add_squares, width))
    scale[scale <= 1e-12 * np.abs(means) * np.sqrt(sums[width:])] = np.nan  # constant but for rounding
    names, tails = list(columns), [c.split(separator)[-1] for c in columns]
    starts = list(range(0, width, COLUMN_BLOCK))
    blocks = [(i, j) for n, i in enumerate(starts) for j in starts[n:]]
    many = max(1, PRODUCTS // COLUMN_BLOCK**2)

    def products(chosen):
        def run(batches):
            import numpy
            import pyarrow

            total = {b: 0.0 for b in chosen}
            for batch in batches:
                z = centred(batch)
                for i, j in chosen:
                    total[i, j] = total[i, j] + z[:, i : i + COLUMN_BLOCK].T @ z[:, j : j + COLUMN_BLOCK]
            rows = [(i, j, numpy.ascontiguousarray(v).tobytes()) for (i, j), v in total.items() if not isinstance(v, float)]
            yield pyarrow.RecordBatch.from_arrays(
                [pyarrow.array([r[k] for r in rows], t) for k, t in enumerate(("int32", "int32", "binary"))], ["i", "j", "v"]
            )

        return run

    def strong(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy
        import pyarrow

        i, j = (k.as_py() for k in key)
        shape = min(COLUMN_BLOCK, width - i), min(COLUMN_BLOCK, width - j)
        total = numpy.zeros(shape)
        for batch in batches:
            for v in batch.column(batch.schema.get_field_index("v")).to_pylist():
                total += numpy.frombuffer(v).reshape(shape)
        with numpy.errstate(divide="ignore", invalid="ignore"):
            r = total / scale[i : i + shape[0], None] / scale[None, j : j + shape[1]]
        rows = [
            (names[i + a], names[j + b], float(r[a, b]))
            for a, b in zip(*numpy.nonzero(numpy.abs(r) > above))
            if i + a < j + b and not (distinct_suffix and tails[i + a] == tails[j + b])
        ]
        yield pyarrow.RecordBatch.from_arrays([pyarrow.array([x[k] for x in rows], t) for k, t in enumerate(("string", "string", "float64"))], ["feature1", "feature2", "correlation"])

    parts = None
    for at in range(0, len(blocks), many):
        part = data.mapInArrow(products(blocks[at : at + many]), "i int, j int, v binary")
        parts = part if parts is None else parts.unionByName(part)
    pairs = stored(parts.groupBy("i", "j").applyInArrow(strong, schema), "correlations")
    data.unpersist()
    ordered = pairs.orderBy(F.desc(F.abs("correlation")), "feature1", "feature2")
    return ordered if top is None else ordered.limit(top)

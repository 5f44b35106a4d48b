"""Confusion tables and classification metrics.

Row-level work is one ``groupBy(label, prediction).count()``, combined before the shuffle.
Everything after that runs on at most K x K rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.expressions import as_column, score_to_class

# The seven metrics in report order.
METRICS = ("accuracy", "error_rate", "precision", "recall", "npv", "specificity", "f1")


def threshold_prediction(score: Column | str, threshold: float = 0.5) -> Column:
    return as_column(score) >= F.lit(threshold)


def accuracy(df: DataFrame, label: str, prediction: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Share of the labelled rows whose prediction equals the label; no prediction is a wrong one."""
    return df.groupBy(*by).agg(_share(F.col(label) == as_column(prediction), F.col(label).isNotNull()))


def _share(hit: Column, labelled: Column) -> Column:
    return F.avg(F.when(labelled, F.coalesce(hit, F.lit(False)).cast("double"))).alias("accuracy")


def accuracy_one_hot(df: DataFrame, labels: Sequence[str], predictions: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A row counts when all its class columns agree."""
    hit = F.lit(True)
    for y, p in zip(labels, predictions, strict=True):
        hit = hit & F.coalesce(F.col(y) == F.col(p), F.lit(False))
    labelled = F.lit(True)
    for y in labels:
        labelled = labelled & F.col(y).isNotNull()
    return df.groupBy(*by).agg(_share(hit, labelled))


def accuracy_scores(
    df: DataFrame, label: str, scores: Sequence[str], threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """Label is a class index (or Boolean for a single score column)."""
    hit = F.col(label).cast("int") == score_to_class(scores, threshold)
    return df.groupBy(*by).agg(_share(hit, F.col(label).isNotNull()))


def confusion_counts(
    df: DataFrame,
    label: str,
    prediction: Column | str,
    by: Sequence[str] = (),
    classes: Sequence[str] | None = None,
) -> DataFrame:
    """Long confusion table ``by, label, prediction, n``; labels as text.

    With ``classes`` the table is zero-filled over their grid and a value outside raises.
    """
    y = F.col(label).cast("string")
    p = as_column(prediction).cast("string")
    if classes is not None:
        names = [str(c) for c in classes]

        def checked(c: Column) -> Column:
            message = F.concat(F.lit("value outside the classes: "), F.coalesce(c, F.lit("null")))
            return F.when(c.isin(*names), c).otherwise(F.raise_error(message))

        y, p = checked(y), checked(p)
    counts = df.groupBy(*by, y.alias("label"), p.alias("prediction")).agg(F.count("*").alias("n"))
    if classes is None:
        return counts
    cells = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction")) for a in names for b in names])
    found = F.map_from_entries(
        F.collect_list(F.struct(F.struct("label", "prediction"), F.col("n")))
    )
    return (
        counts.groupBy(*by)
        .agg(found.alias("_m"))
        .select(*by, "_m", F.explode(cells).alias("_c"))
        .select(*by, "_c.label", "_c.prediction", F.coalesce(F.col("_m")[F.col("_c")], F.lit(0)).cast("long").alias("n"))
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """The four rates of one class against the rest, with the agreed edge values."""
    total = tp + fp + fn + tn
    no_positive, no_negative = tn == total, tp == total
    return {
        "precision": F.when(no_positive, 1.0).otherwise(_ratio(tp, tp + fp)),
        "recall": F.when(no_positive, 1.0).otherwise(_ratio(tp, tp + fn)),
        "npv": F.when(no_negative, 1.0).otherwise(_ratio(tn, tn + fn)),
        "specificity": F.when(no_negative, 1.0).otherwise(_ratio(tn, tn + fp)),
    }


def _f1(precision: Column, recall: Column) -> Column:
    both = precision + recall
    return F.when(both > 0, 2 * precision * recall / both).otherwise(F.lit(0.0))


def binary_metrics(df: DataFrame, label: Column | str, prediction: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Counts and the seven metrics of a Boolean prediction, from one conditional aggregation.

    Rows without a label are left out; a missing prediction counts as the wrong one.
    """
    y, p = as_column(label).cast("boolean"), as_column(prediction).cast("boolean")
    p = F.coalesce(p, ~y)
    counts = df.groupBy(*by).agg(
        F.count_if(p & y).alias("tp"),
        F.count_if(p & ~y).alias("fp"),
        F.count_if(~p & y).alias("fn"),
        F.count_if(~p & ~y).alias("tn"),
    )
    return _binary_rates(counts, by)


def _binary_rates(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    rated = counts.withColumns(
        {"accuracy": _ratio(tp + tn, total), "error_rate": _ratio(fp + fn, total), **_rates(tp, fp, fn, tn)}
    )
    rated = rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    return rated.select(*by, "tp", "fp", "fn", "tn", *METRICS)


def _binary_from_counts(counts: DataFrame, by: Sequence[str], positive: str) -> DataFrame:
    y = F.col("label") == F.lit(positive)
    p = F.coalesce(F.col("prediction") == F.lit(positive), ~y)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    sides = {"tp": p & y, "fp": p & ~y, "fn": ~p & y, "tn": ~p & ~y}
    return _binary_rates(counts.groupBy(*by).agg(*[total(c).alias(k) for k, c in sides.items()]), by)


def binary_metrics_scores(
    df: DataFrame, label: str, score: Column | str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    return binary_metrics(df, label, threshold_prediction(score, threshold), by)


def class_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per class from a long confusion table, each class against the rest.

    A class that is never the truth or never predicted scores 0 on all five rates. A missing
    prediction is a wrong one and no class; rows without a label are left out.
    """
    counts = counts.where(F.col("label").isNotNull())
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")),
    )
    per_class = (
        counts.select(*by, F.explode(sides).alias("_s"))
        .where("_s.class IS NOT NULL")
        .groupBy(*by, F.col("_s.class").alias("class"))
        .agg(
            F.sum("_s.support").alias("support"),
            F.sum("_s.predicted").alias("predicted"),
            F.sum("_s.tp").alias("tp"),
        )
    )
    # one row per class is left here, so the group total is a window over a handful of rows
    group = Window.partitionBy(*(by or [F.lit(0)]))
    totals = per_class.withColumn("total", F.sum("support").over(group))
    tp = F.col("tp")
    fp, fn = F.col("predicted") - tp, F.col("support") - tp
    rates = _rates(tp, fp, fn, F.col("total") - tp - fp - fn)
    seen = (F.col("support") > 0) & (F.col("predicted") > 0)
    rated = totals.withColumns({k: F.when(seen, v).otherwise(F.lit(0.0)) for k, v in rates.items()})
    return rated.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def averaged_metrics(
    counts: DataFrame, by: Sequence[str] = (), weighted: bool = True, positive: str | None = None
) -> DataFrame:
    """The seven metrics per group, averaged over classes by support or equally.

    With ``positive`` the binary metrics of that class are given instead.
    """
    if positive is not None:
        return _binary_from_counts(counts, by, positive).select(*by, *METRICS)
    rates = class_metrics(counts, by)
    total = F.sum("support")

    def mean(c: str) -> Column:
        return _ratio(F.sum(F.col(c) * F.col("support")), total) if weighted else F.avg(c)

    result = rates.groupBy(*by).agg(
        F.coalesce(_ratio(F.sum("tp"), total), F.lit(0.0)).alias("accuracy"),
        *[F.coalesce(mean(c), F.lit(0.0)).alias(c) for c in METRICS[2:]],
    )
    error = F.when(F.col("accuracy").isNotNull(), 1 - F.col("accuracy"))
    return result.withColumn("error_rate", error).select(*by, *METRICS)


def multiclass_metrics(
    df: DataFrame,
    label: str,
    prediction: Column | str,
    by: Sequence[str] = (),
    classes: Sequence[str] | None = None,
    weighted: bool = True,
    positive: str | None = None,
) -> DataFrame:
    """Metrics of any labels; with two classes and ``positive`` the binary definition is used."""
    return averaged_metrics(confusion_counts(df, label, prediction, by, classes), by, weighted, positive)


def multiclass_metrics_scores(
    df: DataFrame,
    label: str,
    scores: Sequence[str],
    threshold: float = 0.5,
    by: Sequence[str] = (),
    weighted: bool = True,
) -> DataFrame:
    """Metrics of a score matrix; the class is the column with the largest score."""
    return multiclass_metrics(df, label, score_to_class(scores, threshold), by, weighted=weighted)


def fold_summary(folds: DataFrame, by: Sequence[str], metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean and sample deviation over folds."""
    return folds.groupBy(*by).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_samp(m).alias(f"{m}_std") for m in metrics]
    )


def confusion_matrix(counts: DataFrame, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The long table as one array-of-arrays per group: rows are true classes, columns predicted."""
    names = F.array(*[F.lit(str(c)) for c in classes])
    cells = F.map_from_entries(F.collect_list(F.struct(F.struct("label", "prediction"), F.col("n"))))
    summed = counts.where(F.col("label").isin(*map(str, classes)) & F.col("prediction").isin(*map(str, classes)))
    summed = summed.groupBy(*by, "label", "prediction").agg(F.sum("n").alias("n"))
    found = summed.groupBy(*by).agg(cells.alias("_m"))

    def cell(a: Column, b: Column) -> Column:
        return F.coalesce(F.col("_m")[F.struct(a.alias("label"), b.alias("prediction"))], F.lit(0))

    return found.select(*by, F.transform(names, lambda a: F.transform(names, lambda b: cell(a, b))).alias("cm"))


def log_loss(df: DataFrame, label: str, probability: str, by: Sequence[str] = (), epsilon: float = 1e-15) -> DataFrame:
    """Mean negative log-probability of the true class; ``probability`` is an array column."""
    p = F.get(F.col(probability), F.col(label).cast("int"))
    bounded = F.least(F.greatest(p, F.lit(epsilon)), F.lit(1 - epsilon))
    return df.groupBy(*by).agg(F.avg(-F.log(bounded)).alias("log_loss"))


def binary_cross_entropy(df: DataFrame, label: str, probability: Column | str, epsilon: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(as_column(probability), F.lit(epsilon)), F.lit(1 - epsilon))
    y = F.col(label).cast("double")
    return df.agg(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("cross_entropy"))

"""Tables behind the result plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_accuracy(results: DataFrame, model: str = "model", accuracy: str = "accuracy") -> DataFrame:
    """Highest accuracy per model, descending."""
    return results.groupBy(model).agg(F.max(accuracy).alias(accuracy)).orderBy(F.desc(accuracy), model)


def best_rows(results: DataFrame, model: str = "model", accuracy: str = "accuracy", order: Sequence[str] = ("config",)) -> DataFrame:
    """The row with the highest accuracy per model, descending."""
    ranked = Window.partitionBy(model).orderBy(F.desc(accuracy), *order)
    best = results.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").drop("_r")
    return best.orderBy(F.desc(accuracy), model)


def grouped_comparison(
    results: DataFrame, model: str = "model", metrics: Sequence[str] = ("accuracy", "f1"), order: Sequence[str] = ("config",)
) -> DataFrame:
    """Best row per model in long form: ``model, metric, value``."""
    best = best_rows(results, model, metrics[0], order)
    return best.unpivot([model], list(metrics), "metric", "value")


def trade_off(results: DataFrame, model: str = "model", x: str = "recall", y: str = "accuracy") -> DataFrame:
    """Points of a two-metric scatter plot."""
    return results.select(model, x, y)

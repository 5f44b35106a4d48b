"""Scaling, imputation and matrix preparation.

Statistics of all columns come from one aggregation and are kept as small fitted values, so
the same parameters can be applied to other data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import valid_or_null
from tabloom.operators.columns import integers_to_double, numeric_columns
from tabloom.operators.splits import holdout, sample_columns, sample_rows


def _statistics(df: DataFrame, columns: Sequence[str], **functions) -> dict[str, list]:
    row = df.agg(*[f(c).alias(f"{k}_{i}") for k, f in functions.items() for i, c in enumerate(columns)]).first()
    return {k: [row[f"{k}_{i}"] for i in range(len(columns))] for k in functions}


def _replace(df: DataFrame, changed: dict[str, Column]) -> DataFrame:
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class ZScore:
    """(x - mean) / sample deviation; a constant column becomes 0."""

    columns: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    epsilon: float = 0.0

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], epsilon: float = 0.0) -> ZScore:
        s = _statistics(df, columns, mean=F.avg, std=F.stddev_samp)
        return cls(tuple(columns), tuple(s["mean"]), tuple(v or 0.0 for v in s["std"]), epsilon)

    def transform(self, df: DataFrame) -> DataFrame:
        changed = {}
        for c, mean, std in zip(self.columns, self.mean, self.std):
            x = F.col(c).cast("double")
            if std + self.epsilon == 0.0 or mean is None:
                changed[c] = F.when(x.isNotNull(), F.lit(0.0))
            else:
                changed[c] = (x - F.lit(float(mean))) / F.lit(float(std) + self.epsilon)
        return _replace(df, changed)


@dataclass(frozen=True)
class MinMax:
    """(x - min) / (max - min); a constant column becomes 0 and new data is not clamped."""

    columns: tuple[str, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> MinMax:
        s = _statistics(df, columns, low=F.min, high=F.max)
        return cls(tuple(columns), tuple(s["low"]), tuple(s["high"]))

    def transform(self, df: DataFrame) -> DataFrame:
        changed = {}
        for c, low, high in zip(self.columns, self.low, self.high):
            x = F.col(c).cast("double")
            if low is None or high == low:
                changed[c] = F.when(x.isNotNull(), F.lit(0.0))
            else:
                changed[c] = (x - F.lit(float(low))) / F.lit(float(high) - float(low))
        return _replace(df, changed)


def z_score(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale with the table's own parameters."""
    return ZScore.fit(df, columns).transform(df)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale with the table's own range."""
    return MinMax.fit(df, columns).transform(df)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null and NaN become the mean of the column's numbers; a column without numbers becomes 0."""
    # the means of all columns come from one pass
    means = _statistics(df, columns, mean=lambda c: F.avg(valid_or_null(c)))["mean"]
    return _replace(
        df, {c: F.coalesce(valid_or_null(c), F.lit(float(m if m is not None else 0.0))) for c, m in zip(columns, means)}
    )


def prepared_matrix(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    max_rows: int | None = None,
    max_columns: int | None = None,
    seed: int = 0,
    epsilon: float = 1e-10,
    output: str = "features",
) -> DataFrame:
    """Numeric columns, optional exact sample, imputed, standardised, as one vector per key."""
    columns = list(columns) if columns is not None else numeric_columns(df, exclude=[key])
    if max_columns is not None:
        columns = sample_columns(columns, max_columns, seed)
    rows = df.select(key, *columns)
    if max_rows is not None:
        rows = sample_rows(rows, key, max_rows, seed)
    filled = impute_mean(rows, columns)
    scaled = ZScore.fit(filled, columns, epsilon).transform(filled)
    return VectorAssembler(inputCols=columns, outputCol=output).transform(scaled).select(key, output)


def prepared_train_test(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    label: str,
    test_fraction: float,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame, MinMax]:
    """Hold out rows, fit the range on the training part and apply it to both parts."""
    rows = integers_to_double(df.select(key, label, *columns).withColumn(key, F.col(key).cast("string")))
    rows = rows.withColumn(label, F.col(label).cast("string"))
    marked = holdout(rows, key, test_fraction, seed)
    train = marked.where(F.col("split") == "train").drop("split")
    test = marked.where(F.col("split") == "test").drop("split")
    scaler = MinMax.fit(train, columns)
    return scaler.transform(train), scaler.transform(test), scaler

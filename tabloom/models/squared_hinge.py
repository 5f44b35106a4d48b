"""Linear classifier with squared hinge loss, all classes fitted in the same passes.

The loss is smooth, so a quasi-Newton method can minimise it with about one pass over the rows per
step. A pass computes, per partition, the loss and gradient of every class with one matrix
product over packed blocks of rows; the driver holds one weight vector per class and its short update history.
Where inputs go through a feature map, a pass maps each block anew, so only the inputs are dealt out and cached.
Fits on several parts of the same rows (folds, held-out rows) share their passes.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import over_blocks, packed, per_batch, summed
from tabloom.functions.expressions import argmax_index
from tabloom.session import VALUES_PER_PARTITION, dealt, keep

MEMORY = 10  # remembered updates per class
BLOCK_ROWS = 1024  # rows that are mapped at once


class SquaredHinge(Estimator):
    """Minimises |w|^2 / (2 * cost * rows) + mean(max(0, 1 - y * margin)^2) per class against the rest.

    It ends when the gradient has shrunk to ``tol`` of its first length, or when a step gains less than a
    thousandth of ``tol`` of the objective; after ``max_iter`` steps without either it warns.
    """

    def __init__(self, classes, cost=1.0, max_iter=200, tol=1e-3, features="features", label="label", mapping=None):
        """``mapping``: a function of a matrix of inputs that gives the matrix to fit."""
        super().__init__()
        self.classes, self.cost, self.max_iter, self.tol = classes, float(cost), max_iter, tol
        self.features, self.label, self.mapping = features, label, mapping

    def _fit(self, df: DataFrame) -> SquaredHingeModel:
        return self.fit_parts(df, [F.lit(True)])[0]

    def fit_parts(self, df: DataFrame, parts: Sequence[Column], costs: Sequence[float] | None = None) -> list[SquaredHingeModel]:
        """A model for each part, a condition on the rows, all fitted in the same passes; ``costs`` has one for each."""
        inside, mapping = F.array(*[F.coalesce(p, F.lit(False)).cast("tinyint") for p in parts]), self.mapping
        rows = df.select(self.features, self.label, inside.alias("_parts")).where(F.array_max("_parts") > 0)
        first = np.array(rows.first()[0].toArray(), dtype=float)[None, :]
        work = 0 if mapping is None else 4 * mapping(first).shape[1]
        total, width = rows.count(), first.shape[1]
        if mapping is None:  # little work on a row: a task takes four times the numbers, as far as all cores have some
            cores = df.sparkSession.sparkContext.defaultParallelism
            few = -(-total * width // VALUES_PER_PARTITION)
            given = {"partitions": max(-(-few // 4), min(few, cores), 1)}
        else:
            given = {"work": work}
        data = keep(packed(dealt(rows, total, width, **given), self.features, self.label, F.col("_parts"), BLOCK_ROWS))
        tasks = data.rdd.getNumPartitions()
        n, mean, deviation = _spread(data, mapping, width if mapping is None else work // 4, len(parts), tasks)
        # a column that varies by rounding errors only is constant
        varies = deviation > 1e-9 * np.abs(mean)
        positives = np.array([1.0] if self.classes <= 2 else range(self.classes), dtype=float)
        each = len(positives)
        scale = np.repeat(np.where(varies, 1.0 / np.where(varies, deviation, 1.0), 0.0), each, axis=0)
        n = np.repeat(np.maximum(n, 1), each)
        penalty = 1.0 / (np.repeat(self.cost if costs is None else np.array(costs, dtype=float), len(n) if costs is None else each) * n)

        def evaluate(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Objective and gradient per part and class; a point holds scaled weights and the intercept."""
            sums = _pass(data, mapping, points[:, :-1] * scale, points[:, -1], positives, tasks) / n[:, None]
            loss, gradient = sums[:, 0], sums[:, 1:]
            gradient[:, :-1] = gradient[:, :-1] * scale + penalty[:, None] * points[:, :-1]
            return loss + 0.5 * penalty * (points[:, :-1] ** 2).sum(axis=1), gradient

        points = _minimise(evaluate, np.zeros((len(n), scale.shape[1] + 1)), self.max_iter, self.tol)
        data.unpersist()
        weights, intercepts = points[:, :-1] * scale, points[:, -1]
        return [SquaredHingeModel(weights[at : at + each], intercepts[at : at + each], self.classes, self.features, mapping) for at in range(0, len(n), each)]


def _spread(data: DataFrame, mapping, width: int, parts: int, tasks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per part: rows, means and sample deviations of the mapped columns; deviations are added up around the means."""

    def of_parts(x, r):
        x = x if mapping is None else mapping(x)
        for part in range(parts):
            here = r[:, part] > 0
            yield part, x if here.all() else x[here]

    def add_values(total, x, y, r):
        for part, own in of_parts(x, r):
            sums = total.reshape(parts, width + 1)[part]
            sums[0] += len(own)
            sums[1:] += own.sum(axis=0)

    sums = summed(data, over_blocks(add_values), parts * (width + 1), tasks).reshape(parts, width + 1)
    n = sums[:, 0].astype("int64")
    mean = sums[:, 1:] / np.maximum(n, 1)[:, None]

    def add_squares(total, x, y, r):
        for part, own in of_parts(x, r):
            total.reshape(parts, width)[part] += ((own - mean[part]) ** 2).sum(axis=0)

    squares = summed(data, over_blocks(add_squares), parts * width, tasks).reshape(parts, width)
    return n, mean, np.sqrt(squares / np.maximum(n - 1, 1)[:, None])


def _pass(data: DataFrame, mapping, weights: np.ndarray, intercepts: np.ndarray, positives: np.ndarray, tasks: int) -> np.ndarray:
    """Per part and class: summed loss, then the gradient by weight and by intercept."""
    count, width = weights.shape

    def add(total, x, y, r):
        import numpy

        x = x if mapping is None else mapping(x)
        block = total.reshape(count, width + 2)
        y = numpy.tile(numpy.where(y[:, None] == positives, 1.0, -1.0), r.shape[1])
        short = numpy.maximum(1.0 - y * (x @ weights.T + intercepts), 0.0)
        if not r.all():
            short *= numpy.repeat(r > 0, len(positives), axis=1)
        push = -2.0 * y * short
        block[:, 0] += (short**2).sum(axis=0)
        block[:, 1:-1] += push.T @ x
        block[:, -1] += push.sum(axis=0)

    return summed(data, over_blocks(add), count * (width + 2), tasks).reshape(count, width + 2)


def _minimise(evaluate, points: np.ndarray, max_iter: int, tol: float) -> np.ndarray:
    """Limited-memory quasi-Newton for independent problems that share each evaluation."""
    count = len(points)
    values, gradients = evaluate(points)
    first = np.linalg.norm(gradients, axis=1)
    history: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(count)]
    steps = np.minimum(1.0, 1.0 / np.maximum(first, 1e-12))
    directions = -gradients.copy()
    active = first > 1e-12
    for _ in range(max_iter):
        if not active.any():
            return points
        trial = points + np.where(active, steps, 0.0)[:, None] * directions
        new_values, new_gradients = evaluate(trial)
        for c in np.nonzero(active)[0]:
            slope = gradients[c] @ directions[c]
            if new_values[c] > values[c] + 1e-4 * steps[c] * slope:
                steps[c] *= 0.5
                active[c] = steps[c] > 1e-10
                continue
            moved, turned = trial[c] - points[c], new_gradients[c] - gradients[c]
            gain = values[c] - new_values[c]
            points[c], values[c], gradients[c] = trial[c], new_values[c], new_gradients[c]
            if moved @ turned > 1e-12:
                history[c] = [*history[c], (moved, turned)][-MEMORY:]
            directions[c], steps[c] = _direction(gradients[c], history[c]), 1.0
            still = np.linalg.norm(gradients[c]) > tol * max(first[c], 1e-12)
            active[c] = still and gain > 1e-3 * tol * max(abs(values[c]), 1e-12)
    if active.any():
        warnings.warn(f"no convergence in {max_iter} steps", stacklevel=2)
    return points


def _direction(gradient: np.ndarray, history) -> np.ndarray:
    q, kept = gradient.copy(), []
    for moved, turned in reversed(history):
        share = (moved @ q) / (moved @ turned)
        kept.append(share)
        q -= share * turned
    if history:
        moved, turned = history[-1]
        q *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(history, reversed(kept)):
        q += moved * (share - (turned @ q) / (moved @ turned))
    return -q


class SquaredHingeModel(Model):
    """Adds ``rawPrediction`` (one margin per class) and ``prediction``."""

    def __init__(self, weights: np.ndarray, intercepts: np.ndarray, classes: int, features: str, mapping=None):
        super().__init__()
        self.weights, self.intercepts = weights, intercepts
        self.classes, self.features, self.mapping = classes, features, mapping

    def _transform(self, df: DataFrame) -> DataFrame:
        weights, intercepts, two, mapping = self.weights.T, self.intercepts, self.classes <= 2, self.mapping

        def margins(x):
            m = np.empty((len(x), len(intercepts)))
            for at in range(0, len(x), BLOCK_ROWS):
                part = x[at : at + BLOCK_ROWS]
                m[at : at + BLOCK_ROWS] = (part if mapping is None else mapping(part)) @ weights + intercepts
            return np.column_stack([-m, m]) if two else m

        scored = df.withColumn("_m", per_batch(margins, vector_to_array(self.features)))
        return scored.withColumns(
            {"rawPrediction": array_to_vector("_m"), "prediction": argmax_index("_m").cast("double")}
        ).drop("_m")

"""Gradient boosting of symmetric trees, one model for any number of classes.

Every tree asks the same question in all nodes of a level, so ``depth`` cuts and a table of leaf values describe it. A
level is one scan: tasks score their rows with the trees so far and add up first and second derivatives of the softmax
loss by leaf, feature, bin and class; the driver takes the cut with the largest gain over all leaves and classes. The
sums of the last level give the leaf values too. Rows carry no state between scans.

``ordered_statistics`` turns a category into a number without leaking a row's own target: the mean target of the rows
that come before it in a random order.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.blocks import over_blocks, packed, per_batch, summed
from tabloom.functions.expressions import argmax_index, as_column, order_key
from tabloom.models.adaboost import cut_points
from tabloom.session import dealt, keep


@dataclass(frozen=True)
class SymmetricTree:
    """A row's leaf has bit j set where its feature j lies above threshold j; ``values`` has a row a leaf."""

    features: tuple[int, ...]
    thresholds: tuple[float, ...]
    values: np.ndarray


def _functions():
    """Leaves and raw scores, as functions that carry nothing but themselves."""

    def leaves(x, features, thresholds):
        import numpy

        leaf = numpy.zeros(len(x), dtype="int64")
        for j, (f, t) in enumerate(zip(features, thresholds)):
            leaf |= (x[:, f] > t).astype("int64") << j
        return leaf

    def probabilities(x, trees, classes):
        import numpy

        score = numpy.zeros((len(x), classes))
        for features, thresholds, values in trees:
            score += values[leaves(x, features, thresholds)]
        score = numpy.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)

    return leaves, probabilities


class SymmetricBoosting(Estimator):
    """``l2`` is added to the second derivatives of a leaf; ``bins`` - 1 cuts of each feature are tried."""

    def __init__(self, classes, iterations=100, learning_rate=0.1, depth=6, l2=3.0, bins=64, features="features", label="label"):
        super().__init__()
        if not 1 <= depth <= 16:
            raise ValueError("symmetric trees have 1 to 16 levels")
        self.classes, self.iterations, self.learning_rate, self.depth = max(classes, 2), iterations, learning_rate, depth
        self.l2, self.bins, self.features, self.label = float(l2), bins, features, label

    def _fit(self, df: DataFrame) -> SymmetricBoostingModel:
        rows = df.select(self.features, self.label)
        width = rows.select(self.features).first()[0].size
        blocks = keep(packed(dealt(rows, rows.count(), 4 * width), self.features, self.label, F.array(F.lit(1))))
        cuts = cut_points(rows.select(vector_to_array(self.features).alias("x")), width, self.bins)
        trees: list[SymmetricTree] = []
        for _ in range(self.iterations):
            tree = self._tree(blocks, trees, cuts)
            if tree is None:
                break
            trees.append(tree)
        blocks.unpersist()
        return SymmetricBoostingModel(trees, self.classes, self.features)

    def _tree(self, blocks: DataFrame, trees: Sequence[SymmetricTree], cuts: list[np.ndarray]) -> SymmetricTree | None:
        features: tuple[int, ...] = ()
        thresholds: tuple[float, ...] = ()
        sides = None
        for level in range(self.depth):
            sums = _derivatives(blocks, trees, (features, thresholds), cuts, self.classes)
            best = None
            for f, table in enumerate(sums):
                below = table.cumsum(axis=1)
                both = np.stack([below[:, :-1], below[:, -1:] - below[:, :-1]])  # side, leaf, cut, class, derivative
                gain = (both[..., 0] ** 2 / (both[..., 1] + self.l2)).sum(axis=(0, 1, 3))
                if len(gain) and (best is None or gain.max() > best[0] * (1 + 1e-12)):
                    best = gain.max(), f, int(gain.argmax()), both
            if best is None:  # all features are constant
                return None
            _, f, i, both = best
            features, thresholds = (*features, f), (*thresholds, float(cuts[f][i]))
            sides = both[:, :, i]
        slope, curve = sides[..., 0].reshape(-1, self.classes), sides[..., 1].reshape(-1, self.classes)
        return SymmetricTree(features, thresholds, self.learning_rate * slope / (curve + self.l2))


def _derivatives(blocks, trees, levels, cuts, classes) -> list[np.ndarray]:
    """Sums of (target - probability) and of p (1 - p): by feature an array (leaf, bin, class, derivative)."""
    leaves, probabilities = _functions()
    known = [(t.features, t.thresholds, t.values) for t in trees]
    lengths = [len(c) + 1 for c in cuts]
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
    total_bins, many = int(starts[-1]), 1 << len(levels[0])

    def add(total, x, y, r):
        import numpy

        here = ~numpy.isnan(y)
        x, y = x[here], y[here].astype("int64")
        p = probabilities(x, known, classes)
        slope = -p
        slope[numpy.arange(len(y)), y] += 1
        leaf = leaves(x, *levels)
        place = numpy.empty(x.shape, dtype="int64")
        for f, c in enumerate(cuts):
            place[:, f] = leaf * total_bins + starts[f] + numpy.searchsorted(c, x[:, f], side="left")
        flat, cells = place.ravel(), many * total_bins
        for c in range(classes):
            for kind, values in enumerate((slope[:, c], p[:, c] * (1 - p[:, c]))):
                at = (c * 2 + kind) * cells
                total[at : at + cells] += numpy.bincount(flat, numpy.repeat(values, x.shape[1]), minlength=cells)

    sums = summed(blocks, over_blocks(add), classes * 2 * many * total_bins).reshape(classes, 2, many, total_bins)
    moved = sums.transpose(2, 3, 0, 1)
    return [moved[:, a:b] for a, b in zip(starts, starts[1:])]


class SymmetricBoostingModel(Model):
    """Adds ``probability`` and ``prediction``."""

    def __init__(self, trees: Sequence[SymmetricTree], classes: int, features: str):
        super().__init__()
        self.trees, self.classes, self.features = list(trees), classes, features

    def _transform(self, df: DataFrame) -> DataFrame:
        _, probabilities = _functions()
        known, classes = [(t.features, t.thresholds, t.values) for t in self.trees], self.classes
        scored = df.withColumn("_p", per_batch(lambda x: probabilities(x, known, classes), vector_to_array(self.features)))
        return scored.withColumn("probability", array_to_vector("_p")).withColumn("prediction", argmax_index("_p").cast("double")).drop("_p")


BUCKET = 3  # hex digits: 4,096 buckets of the random order


def ordered_statistics(
    df: DataFrame, category: Column | str, target: Column | str, ids: Sequence[str], seed: int = 0, prior: float = 0.5, weight: float = 1.0, output: str = "statistic"
) -> DataFrame:
    """Add the mean target of earlier rows of the same category, drawn to ``prior`` with the given weight.

    Rows are in the order of md5(seed, ids); a null target counts for nothing, a null category is one of its own. A
    category that holds most rows is cut into buckets of the order: buckets are added up first, and only the rows of one
    bucket meet in a task.
    """
    value = as_column(target).cast("double")
    rows = df.withColumns({"_category": as_column(category), "_key": order_key(seed, *ids), "_value": value})
    rows = rows.withColumn("_bucket", F.substring("_key", 1, BUCKET))
    sums = rows.groupBy("_category", "_bucket").agg(F.sum("_value").alias("_s"), F.count("_value").alias("_n"))
    earlier = Window.partitionBy("_category").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_category").alias("_of"), F.col("_bucket").alias("_in"),
        F.coalesce(F.sum("_s").over(earlier), F.lit(0.0)).alias("_before"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_count"),
    )
    within = Window.partitionBy("_category", "_bucket").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({"_s": F.coalesce(F.sum("_value").over(within), F.lit(0.0)), "_n": F.count("_value").over(within)})
    joined = local.join(offsets, F.col("_category").eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_in")))
    mean = (F.col("_before") + F.col("_s") + prior * weight) / (F.col("_count") + F.col("_n") + weight)
    return joined.withColumn(output, mean).select(*df.columns, output)

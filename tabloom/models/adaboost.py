"""AdaBoost on decision stumps for any number of classes (SAMME), with exact stumps.

Values are looked at as whole numbers in the same order (the bits of a double), so that ranges of values can be cut
evenly however they are spread. A round starts from ranges between ``bins`` - 1 cuts of a sketch. One scan recomputes
each row's weight from the stumps found so far and adds up weight by range and class. The best cut between two ranges
is then known exactly, and so is a bound on what any cut inside a range could reach; only ranges whose bound is better
are cut further, by scans over the rows inside them, until none is left. The stump is thus the best of all cuts, as a
search over every value would find it. Rows never carry state from round to round, so nothing has to be checkpointed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import over_blocks, packed, per_batch, summed
from tabloom.functions.expressions import argmax_index
from tabloom.session import TASKS_PER_CORE, dealt, keep



SUMMED = 1_000_000  # numbers that one scan adds up when ranges are cut again


@dataclass(frozen=True)
class Stump:
    """Class ``left`` where the feature is at most the threshold, else ``right``."""

    feature: int
    bin: int
    threshold: float
    left: int
    right: int
    weight: float = 1.0


class AdaBoost(Estimator):
    """``bins`` is where a round starts and how finely a range is cut again; the result does not depend on it."""

    def __init__(self, classes, n_estimators=50, learning_rate=1.0, features="features", label="label", seed=0, bins=256):
        super().__init__()
        if bins < 2:
            raise ValueError("at least 2 bins")
        self.bins = bins
        self.classes, self.n_estimators, self.learning_rate = classes, n_estimators, learning_rate
        self.features, self.label, self.seed = features, label, seed

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        rows = df.select(self.features, self.label)
        n, width = rows.where(F.col(self.label).isNotNull()).count(), rows.select(self.features).first()[0].size
        blocks = keep(packed(dealt(rows, n, 4 * width), self.features, self.label, F.array(F.lit(1))))
        cuts = [ordered_bits(c) for c in cut_points(rows.select(vector_to_array(self.features).alias("x")), width, self.bins)]
        stumps: list[Stump] = []
        log_total = math.log(max(n, 1))
        for _ in range(self.n_estimators):
            found, error, total = _best_stump(blocks, stumps, log_total, cuts, self.classes, self.bins)
            if error >= 1.0 - 1.0 / self.classes - 1e-12:
                if not stumps:
                    stumps.append(found)
                break
            share = max(error, 1e-12)
            weight = self.learning_rate * (math.log((1 - share) / share) + math.log(max(self.classes - 1, 1)))
            stumps.append(replace(found, weight=weight))
            if error <= 1e-12:
                break
            # the weights of the next round sum to one again
            log_total += math.log(total * (1 - error + error * math.exp(weight)))
        blocks.unpersist()
        return AdaBoostModel(tuple(stumps), self.classes, self.features)


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, ~(bits & np.int64(0x7FFFFFFFFFFFFFFF)) + np.int64(1), bits)


def value_of(bits: int) -> float:
    """The double with the given place in the order."""
    return float(np.int64(bits).view(np.float64)) if bits >= 0 else -float(np.int64(-bits).view(np.float64))


def _best_stump(blocks, stumps, log_total, cuts, classes, bins) -> tuple[Stump, float, float]:
    """The stump with the smallest weighted error, its error, and the weight of all rows; the first feature and lowest cut on ties.

    ``ranges`` are (feature, edges, weights below the first edge): a range between two edges holds values above the lower
    and at most the upper one.
    """
    ends = np.iinfo(np.int64)
    ranges = [(f, np.concatenate([[ends.min], c, [ends.max]]), None) for f, c in enumerate(cuts)]
    best, total, outer = None, None, None
    while ranges:
        tables = _range_weights(blocks, stumps, log_total, ranges, classes)
        if total is None:
            outer = tables[0].sum(axis=0)
            total = float(outer.sum())
            winner = int(outer.argmax())
            # a stump without a cut, for rows that no feature tells apart
            best = (float(outer.max()), math.inf, math.inf, winner, winner, math.inf)
        sums = []
        for (f, edges, before), table in zip(ranges, tables):
            below = (0.0 if before is None else before) + table.cumsum(axis=0)
            below = np.vstack([np.zeros(classes) if before is None else before, below])
            sums.append(below)
            value = below.max(axis=1) + (outer - below).max(axis=1)
            # a cut needs rows on both sides
            real = (below.sum(axis=1) > 0) & ((outer - below).sum(axis=1) > total * 1e-15)
            value[~real] = -1
            i = int(value.argmax())
            better = value[i] - best[0]
            if better > 1e-12 * total or (abs(better) <= 1e-12 * total and (f, int(edges[i])) < best[1:3]):
                best = (float(value[i]), f, int(edges[i]), int(below[i].argmax()), int((outer - below[i]).argmax()), f)
        open_ = [
            (f, edges[i], edges[i + 1], below[i])
            for (f, edges, _), table, below in zip(ranges, tables, sums)
            for i in np.flatnonzero(_could_win(below, table, outer, best[0], total))
            if int(edges[i + 1]) - int(edges[i]) > 1
        ]
        parts = max(2, min(bins, SUMMED // max(len(open_) * classes, 1)))
        ranges = [(f, _finer(low, high, parts), below) for f, low, high, below in open_]
    reached, f, bits, left, right, _ = best
    if f == math.inf:
        return Stump(0, 0, math.inf, left, right), 1.0 - reached / total, total
    return Stump(int(f), int(bits), value_of(int(bits)), left, right), max(1.0 - reached / total, 0.0), total


def _could_win(below: np.ndarray, table: np.ndarray, outer: np.ndarray, best: float, total: float) -> np.ndarray:
    """Which ranges might hold a better cut: some rows of class a go left and some of class b go right."""
    left, right = below[:-1], outer - below[1:]
    reach = left[:, :, None] + right[:, None, :] + table[:, :, None] + table[:, None, :]
    same = np.arange(table.shape[1])
    reach[:, same, same] -= table
    mixed = (table > 0).sum(axis=1) > 1  # rows of one class are never parted to advantage
    return mixed & (reach.max(axis=(1, 2)) > best + 1e-12 * total)


def _finer(low: int, high: int, bins: int) -> np.ndarray:
    """At most ``bins`` even parts of a range."""
    low, high = int(low), int(high)
    parts = min(bins, high - low)
    return np.array([low + (high - low) * i // parts for i in range(parts + 1)], np.int64)


def _merged(listed) -> tuple[np.ndarray, np.ndarray]:
    """The edges of a feature's ranges in one row, and which sum each part between two of them belongs to; -1 for none."""
    points, target = [], []
    for edges, at in sorted(listed, key=lambda e: int(e[0][0])):
        if points and points[-1] != edges[0]:
            target.append(-1)
        if not points or points[-1] != edges[0]:
            points.append(edges[0])
        points += list(edges[1:])
        target += range(at, at + len(edges) - 1)
    return np.array(points, np.int64), np.array(target, np.int64)


def _range_weights(blocks, stumps, log_total, ranges, classes) -> list[np.ndarray]:
    """Weight by part and class for every range: one scan."""
    rules = [(s.feature, s.threshold, s.left, s.right, s.weight) for s in stumps]
    offsets = np.concatenate([[0], np.cumsum([len(edges) - 1 for _, edges, _ in ranges])]).astype(int)
    by_feature: dict[int, list] = {}
    for (f, edges, _), at in zip(ranges, offsets):
        by_feature.setdefault(f, []).append((edges, int(at)))
    plans = [(f, *_merged(listed)) for f, listed in by_feature.items()]

    def add(total, x, y, r):
        import numpy

        here = ~numpy.isnan(y)
        x, y = x[here], y[here].astype("int64")
        raised = numpy.full(len(y), -log_total)
        for feature, threshold, left, right, weight in rules:
            raised += weight * (numpy.where(x[:, feature] <= threshold, left, right) != y)
        weights = numpy.exp(raised)
        for f, points, target in plans:
            bits = (x[:, f] + 0.0).view("int64")
            bits = numpy.where(bits < 0, ~(bits & 0x7FFFFFFFFFFFFFFF) + 1, bits)
            part = numpy.searchsorted(points, bits, side="left") - 1
            inside = (part >= 0) & (part < len(target))
            inside[inside] = target[part[inside]] >= 0
            place = target[part[inside]] * classes + y[inside]
            total += numpy.bincount(place, weights[inside], minlength=len(total))

    sums = summed(blocks, over_blocks(add), int(offsets[-1]) * classes).reshape(-1, classes)
    return [sums[a:b] for a, b in zip(offsets, offsets[1:])]


def cut_points(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Candidate thresholds per feature from one sketch pass; the largest value is no cut.

    One task merges the sketches of all partitions, and each merge costs more than the one before. So there are at most
    ``TASKS_PER_CORE`` sketches a core, however many partitions the rows lie in.
    """
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    sketches = TASKS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism
    found = rows.coalesce(sketches).agg(
        *[F.percentile_approx(F.col("x")[i], probs, F.lit(10_000)).alias(f"q{i}") for i in range(width)],
        *[F.max(F.col("x")[i]).alias(f"m{i}") for i in range(width)],
    ).first()
    return [np.array(sorted({v for v in found[f"q{i}"] if v < found[f"m{i}"]})) for i in range(width)]


class AdaBoostModel(Model):
    """``probability`` is each class's share of the stump weights."""

    def __init__(self, stumps: tuple[Stump, ...], classes: int, features: str):
        super().__init__()
        self.stumps, self.classes, self.features = stumps, classes, features

    def _transform(self, df: DataFrame) -> DataFrame:
        feature, threshold = (np.array([getattr(s, k) for s in self.stumps]) for k in ("feature", "threshold"))
        sides = np.zeros((2, len(self.stumps), self.classes))
        for i, s in enumerate(self.stumps):
            sides[0, i, s.left] = sides[1, i, s.right] = s.weight
        total = float(sum(s.weight for s in self.stumps)) or 1.0

        def votes(x: np.ndarray) -> np.ndarray:
            out = np.empty((len(x), sides.shape[2]))
            for at in range(0, len(x), 1000):
                low = x[at : at + 1000][:, feature] <= threshold
                out[at : at + 1000] = low @ sides[0] + ~low @ sides[1]
            return out

        return (
            df.withColumn("_votes", per_batch(votes, vector_to_array(self.features)))
            .withColumn("prediction", argmax_index("_votes").cast("double"))
            .withColumn("probability", array_to_vector(F.transform("_votes", lambda v: v / F.lit(total))))
            .drop("_votes")
        )

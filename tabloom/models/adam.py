"""Feed-forward networks trained by full-batch Adam, any number of them in the same scans.

The rows are packed into blocks of matrices once. An epoch is one job: every task back-propagates its blocks through
all networks that are still training, Spark adds the gradients and losses up, and the driver, which holds weights and
both moments, takes the steps. What a row is to a network (training, validation, test or nothing) is one of its roles,
so networks of many settings, folds and executions need as many jobs as the longest of them has epochs. Rows that are
equal in inputs, label and roles are one row with a weight: the loss is a sum over rows, so it is the same.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import counted, over_blocks, packed_counted, per_batch, summed
from tabloom.functions.expressions import argmax_index
from tabloom.session import dealt, keep

NOTHING, TRAIN, VALIDATION, TEST = range(4)
BETAS, EPSILON = (0.9, 0.999), 1e-8
WEIGHTS_PER_NUMBER = 16  # weights that take about as long as scanning one number; rows are dealt out by that


@dataclass
class Network:
    """One network and the state of its training. ``role`` is its place among the roles of a row."""

    width: int
    topology: Sequence[int]
    classes: int
    learning_rate: float = 0.01
    max_epochs: int = 1000
    min_loss: float = 0.0
    patience: int = 20
    seed: int = 0
    role: int = 0
    weights: np.ndarray = field(init=False)
    history: list[tuple] = field(default_factory=list)

    def __post_init__(self):
        rng, parts = np.random.default_rng(self.seed), []
        for a, b in self.shapes():
            bound = np.sqrt(6 / (a + b))
            parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
        self.weights = np.concatenate(parts)
        self.moments = [np.zeros_like(self.weights), np.zeros_like(self.weights)]
        self.best, self.best_loss, self.waited, self.epoch, self.done = self.weights, np.inf, 0, 0, False

    def shapes(self) -> list[tuple[int, int]]:
        sizes = [self.width, *self.topology, self.classes]
        return list(zip(sizes, sizes[1:]))

    def take(self, losses: np.ndarray, counts: np.ndarray, gradient: np.ndarray) -> None:
        """Note the losses of the present weights; then step, unless training is over."""
        if not counts[0]:
            raise ValueError("a network needs training rows")
        train, validation, test = (float(v / n) if n else None for v, n in zip(losses, counts))
        self.history.append((self.epoch, train, validation, test))
        if validation is None:
            self.best = self.weights
        elif self.epoch:  # untrained weights are no candidate
            if validation < self.best_loss:
                self.best, self.best_loss, self.waited = self.weights, validation, 0
            else:
                self.waited += 1
        if self.epoch >= self.max_epochs or train <= self.min_loss or self.waited >= self.patience:
            self.done = True
            return
        self.epoch += 1
        gradient = gradient / counts[0]
        first, second = self.moments
        self.moments = [BETAS[0] * first + (1 - BETAS[0]) * gradient, BETAS[1] * second + (1 - BETAS[1]) * gradient**2]
        unbiased = [m / (1 - b**self.epoch) for m, b in zip(self.moments, BETAS)]
        self.weights = self.weights - self.learning_rate * unbiased[0] / (np.sqrt(unbiased[1]) + EPSILON)


def _passes():
    """Forward and backward passes of flat weights, as functions that carry nothing but themselves."""

    def layers(flat, shapes):
        at = 0
        for a, b in shapes:
            yield flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + (a + 1) * b]
            at += (a + 1) * b

    def forward(x, flat, shapes):
        import numpy

        outputs = [x]
        for number, (w, b) in enumerate(layers(flat, shapes)):
            z = outputs[-1] @ w + b
            if number < len(shapes) - 1:
                outputs.append(1 / (1 + numpy.exp(-numpy.clip(z, -500, 500))))
            else:
                z = numpy.exp(z - z.max(axis=1, keepdims=True))
                outputs.append(z / z.sum(axis=1, keepdims=True))
        return outputs

    def backward(outputs, target, weight, flat, shapes):
        """Gradient of the summed cross-entropy."""
        import numpy

        parts, pairs = [], list(layers(flat, shapes))
        delta = outputs[-1].copy()
        delta[numpy.arange(len(target)), target] -= 1
        delta *= weight[:, None]
        for number in range(len(shapes) - 1, -1, -1):
            before = outputs[number]
            parts = [(before.T @ delta).ravel(), delta.sum(axis=0), *parts]
            if number:
                delta = (delta @ pairs[number][0].T) * before * (1 - before)
        return numpy.concatenate(parts)

    return forward, backward


def network_blocks(df: DataFrame, features: str, label: str, roles: Column, networks: Sequence[Network]) -> DataFrame:
    """Different rows with their number, dealt out and packed for ``train_together``, and cached."""
    rows = keep(counted(df, features, label, roles))
    work = sum(len(n.weights) for n in networks) // WEIGHTS_PER_NUMBER
    blocks = keep(packed_counted(dealt(rows, rows.count(), networks[0].width, work=work)))
    blocks.count()
    rows.unpersist()
    return blocks


def train_together(blocks: DataFrame, networks: Sequence[Network]) -> None:
    """Train all networks on packed blocks (see ``network_blocks``); an epoch of all of them is one job."""
    forward, backward = _passes()
    parts = blocks.rdd.getNumPartitions()
    while True:
        active = [n for n in networks if not n.done]
        if not active:
            return
        plans, length = [], 0
        for n in active:
            plans.append((length, n.role, n.weights, n.shapes()))
            length += 6 + len(n.weights)

        def add(total, x, y, r, w=None, plans=plans):
            import numpy

            w = numpy.ones(len(y)) if w is None else w
            for at, role, flat, shapes in plans:
                mine = r[:, role]
                here = (mine > 0) & ~numpy.isnan(y)
                if not here.any():
                    continue
                part, target, weight = mine[here], y[here].astype("int64"), w[here]
                outputs = forward(x[here], flat, shapes)
                loss = -numpy.log(numpy.maximum(outputs[-1][numpy.arange(len(target)), target], 1e-300))
                total[at : at + 3] += numpy.bincount(part, loss * weight, 4)[1:4]
                total[at + 3 : at + 6] += numpy.bincount(part, weight, 4)[1:4]
                taught = part == 1
                if taught.any():
                    total[at + 6 : at + 6 + len(flat)] += backward([o[taught] for o in outputs], target[taught], weight[taught], flat, shapes)

        sums = summed(blocks, over_blocks(add), length, parts)
        for n, (at, *_) in zip(active, plans):
            n.take(sums[at : at + 3], sums[at + 3 : at + 6], sums[at + 6 : at + 6 + len(n.weights)])


def confusion_together(blocks: DataFrame, networks: Sequence[Network]) -> np.ndarray:
    """(network, true class, predicted class) counts of the test rows, in one scan; a class of no network counts last."""
    forward, _ = _passes()
    plans = [(n.role, n.best, n.shapes()) for n in networks]
    classes = networks[0].classes

    def add(total, x, y, r, w=None):
        import numpy

        w = numpy.ones(len(y)) if w is None else w
        for number, (role, flat, shapes) in enumerate(plans):
            here = r[:, role] == 3
            if here.any():
                found = forward(x[here], flat, shapes)[-1].argmax(axis=1)
                true = numpy.where(numpy.isnan(y[here]), classes, y[here]).astype("int64")
                place = (number * (classes + 1) + true) * classes + found
                total += numpy.bincount(place, w[here], len(total))

    return summed(blocks, over_blocks(add), len(plans) * (classes + 1) * classes).reshape(len(plans), classes + 1, classes)


class AdamModel(Model):
    """Adds ``probability`` and ``prediction``; ``history`` holds the losses before training and after every epoch."""

    def __init__(self, network: Network, features: str):
        super().__init__()
        self.weights, self.shapes, self.features, self.history = network.best, network.shapes(), features, network.history

    def _transform(self, df: DataFrame) -> DataFrame:
        forward, _ = _passes()
        weights, shapes = self.weights, self.shapes
        scored = df.withColumn("_p", per_batch(lambda x: forward(x, weights, shapes)[-1], vector_to_array(self.features)))
        return scored.withColumn("probability", array_to_vector("_p")).withColumn("prediction", argmax_index("_p").cast("double")).drop("_p")

    def losses(self, df: DataFrame) -> DataFrame:
        """Loss curves: ``epoch, train_loss, validation_loss, test_loss``."""
        schema = "epoch int, train_loss double, validation_loss double, test_loss double"
        return df.sparkSession.createDataFrame(self.history, schema)


__all__ = ["NOTHING", "TEST", "TRAIN", "VALIDATION", "WEIGHTS_PER_NUMBER", "AdamModel", "Network", "confusion_together", "network_blocks", "train_together"]

"""Principal components of wide tables, without a matrix of columns x columns.

A block of random directions is multiplied by the scatter matrix in one scan: every task sums the products of
its own centred rows, columns x block numbers. The directions found so far and their products span a space in
which the leading components are looked for, and each further scan widens it by the part of the last products
that is new (block Krylov steps). A component is done when its residual, which bounds the error of its
variance, is below ``tol`` of the mean variance of a column. When the space has grown to several blocks it shrinks to
its best directions, whose products are known already, so that costs no scan.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import summed, vector_map
from tabloom.operators.reduction import PrincipalComponentsModel
from tabloom.session import dealt, keep

BLOCKS = 8  # the space grows to so many blocks before it shrinks
ROUNDING = 1e-13  # residuals below this share of the largest variance cannot be told from rounding


class WidePrincipalComponents(Estimator):
    """``k`` components, or the fewest that explain ``variance_ratio``; the ratio wins when both are given.

    The driver and every task hold columns x (a few times ``k``) numbers. Rows without a vector are left out of the
    fit and have no scores. Scores are centred on the fitting data and the largest loading of every component is
    positive. A table of fewer than two rows has components of variance zero. It warns when ``max_scans`` are not
    enough.
    """

    def __init__(self, features="features", output="scores", k: int | None = None, variance_ratio: float | None = None, tol=1e-7, max_scans=200, seed=0):
        super().__init__()
        if k is None and variance_ratio is None:
            raise ValueError("give k or variance_ratio")
        self.features, self.output, self.k, self.variance_ratio = features, output, k, variance_ratio
        self.tol, self.max_scans, self.seed = tol, max_scans, seed

    def _fit(self, df: DataFrame) -> WidePrincipalComponentsModel:
        vectors = df.select(self.features).where(F.col(self.features).isNotNull())
        s = Summarizer.metrics("count", "mean", "variance").summary(F.col(self.features))
        # grouped by a constant, an empty table has no group; the summary itself fails on no rows
        found = vectors.groupBy(F.lit("all")).agg(s.alias("s")).select("s.count", "s.mean", "s.variance").first()
        if found is None:
            raise ValueError("no rows to fit components on")
        mean, total = found["mean"].toArray(), found["variance"].toArray().sum() * (found["count"] - 1)
        width, ratio = len(mean), self.variance_ratio
        rows = keep(dealt(vectors.select(vector_to_array(self.features).alias("x")), found["count"], width))
        space = Space(lambda directions: scatter_product(rows, mean, directions), width, self.seed)
        wanted = min(self.k or 8, width) if ratio is None else min(8, width)
        floor = self.tol * total / width
        while True:
            values, loadings, residual = space.leading(wanted, floor, self.max_scans)
            shares = values / total if total > 0 else np.zeros(wanted)
            if ratio is None or wanted == width or np.cumsum(shares)[-1] >= ratio - 1e-12 or space.scans >= self.max_scans:
                break
            wanted = min(2 * wanted, width)
        rows.unpersist()
        if residual > max(floor, ROUNDING * values[0]):
            warnings.warn(f"components have a residual of {residual:.3g} after {space.scans} scans", stacklevel=2)
        if ratio is not None:
            reached = np.nonzero(np.cumsum(shares) >= ratio - 1e-12)[0]
            wanted = int(reached[0]) + 1 if len(reached) else wanted
        largest = np.abs(loadings).argmax(axis=0)
        loadings = loadings * np.where(loadings[largest, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)
        return WidePrincipalComponentsModel(self, mean, loadings[:, :wanted], shares, wanted, space.scans)


class WidePrincipalComponentsModel(Model):
    """Adds the scores as a vector; ``shares`` are those of all components that were looked for."""

    variance = PrincipalComponentsModel.variance

    def __init__(self, fit: WidePrincipalComponents, mean: np.ndarray, components: np.ndarray, shares: np.ndarray, k: int, scans: int):
        super().__init__()
        self.features, self.output, self.mean = fit.features, fit.output, mean
        self.components, self.shares, self.k, self.scans = components, shares, k, scans

    def _transform(self, df: DataFrame) -> DataFrame:
        components, offset = self.components, self.mean @ self.components
        given = df.where(F.col(self.features).isNotNull())
        return given.withColumn(self.output, vector_map(lambda x: x @ components - offset, self.features))


def scatter_product(rows: DataFrame, mean: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Scatter matrix of the centred rows times the directions, in one scan."""
    shape = directions.shape

    def add(total, batch):
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - mean
        total += (x.T @ (x @ directions)).ravel()

    return summed(rows, add, directions.size).reshape(shape)


class Space:
    """Orthonormal directions ``basis`` with their products, widened a block at a time."""

    def __init__(self, product, width: int, seed: int):
        self.product, self.width, self.scans = product, width, 0
        self.rng = np.random.default_rng(seed)
        self.basis = self.images = np.zeros((width, 0))

    def leading(self, k: int, floor: float, max_scans: int) -> tuple[np.ndarray, np.ndarray, float]:
        """The ``k`` largest variances, their directions and the largest residual; stops when that is at most ``floor``."""
        size, fresh = min(self.width, k + 10), self.images[:, -(k + 10):]
        while True:
            residual = np.inf
            if self.basis.shape[1] >= k:
                inner = self.basis.T @ self.images
                values, turn = np.linalg.eigh((inner + inner.T) / 2)
                order = np.argsort(-values)
                values, turn = values[order], turn[:, order]
                apart = self.images @ turn[:, :k] - (self.basis @ turn[:, :k]) * values[:k]
                residual = np.linalg.norm(apart, axis=0).max()
                if residual <= max(floor, ROUNDING * abs(values[0])) or self.basis.shape[1] == self.width or self.scans >= max_scans:
                    return np.maximum(values[:k], 0), self.basis @ turn[:, :k], residual if self.basis.shape[1] < self.width else 0.0
                if self.basis.shape[1] + size > max(BLOCKS * size, 2 * k):
                    self.basis, self.images = self.basis @ turn[:, :size], self.images @ turn[:, :size]
                    fresh = apart
            block = self._new(fresh, size)
            fresh = self.product(block)
            self.scans += 1
            self.basis, self.images = np.hstack([self.basis, block]), np.hstack([self.images, fresh])

    def _new(self, candidates: np.ndarray, size: int) -> np.ndarray:
        """The parts of the candidates outside the space; random directions where nothing is left of them."""
        room = min(size, self.width - self.basis.shape[1])
        for source in (candidates, self.rng.normal(size=(self.width, room))):
            lengths = np.linalg.norm(source, axis=0)
            part = source[:, lengths > 0] / lengths[lengths > 0]
            for _ in range(2):
                part = part - self.basis @ (self.basis.T @ part)
            if part.shape[1] == 0:
                continue
            left, strength, _ = np.linalg.svd(part, full_matrices=False)
            block = left[:, strength > 1e-8][:, :room]
            if block.shape[1]:
                block = block - self.basis @ (self.basis.T @ block)
                return np.linalg.qr(block)[0]
        raise ArithmeticError("no direction outside the space was found")

"""Linear and kernel support vector machines, and margins turned into probabilities."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.blocks import vector_map
from tabloom.functions.expressions import derived_seed, order_key, uniform_hash
from tabloom.models.squared_hinge import SquaredHinge

# Kernels and their default settings.
KERNELS = ("linear", "rbf", "sigmoid", "poly")
KERNEL_DEFAULTS = {"kernel": "sigmoid", "cost": 1.0, "gamma": 0.1, "degree": 3, "coef0": 0.0}


class KernelFeatures(Estimator):
    """An explicit feature map whose inner products approximate a kernel.

    rbf: random Fourier features. poly and sigmoid: kernel values against ``components``
    landmark rows, rescaled by the landmarks' own kernel matrix. Cost per row is fixed, so the
    map works on any number of rows; only the landmarks and weights travel to the tasks.
    """

    def __init__(self, kernel, gamma=0.1, degree=3, coef0=0.0, components=200, features="features", output="_kernel", seed=0):
        super().__init__()
        self.kernel, self.gamma, self.degree, self.coef0 = kernel, float(gamma), int(degree), float(coef0)
        self.components, self.features, self.output, self.seed = components, features, output, seed

    def _fit(self, df: DataFrame) -> KernelFeaturesModel:
        rng = np.random.default_rng(self.seed)
        gamma, degree, coef0, kind = self.gamma, self.degree, self.coef0, self.kernel
        if kind == "rbf":
            width = df.select(self.features).first()[0].size
            directions = rng.normal(0.0, np.sqrt(2 * gamma), (width, self.components))
            phases = rng.uniform(0, 2 * np.pi, self.components)
            scale = np.sqrt(2.0 / self.components)
            return KernelFeaturesModel(self.features, self.output, lambda x: scale * np.cos(x @ directions + phases))
        # landmarks: the rows with the smallest hash of their own values; duplicates count once
        landmarks = (
            df.select(vector_to_array(self.features).alias("x"))
            .withColumn("k", order_key(self.seed, F.col("x").cast("string")))
            .groupBy("k")
            .agg(F.first("x").alias("x"))
            .orderBy("k")
            .limit(self.components)
            .collect()
        )
        anchors = np.array([r["x"] for r in landmarks])

        def kernel(x, y):
            inner = gamma * (x @ y.T) + coef0
            return inner**degree if kind == "poly" else np.tanh(inner)

        values, vectors = np.linalg.eigh(kernel(anchors, anchors))
        keep = values > max(values.max(), 0) * 1e-10
        rescale = vectors[:, keep] / np.sqrt(values[keep]) if keep.any() else np.eye(len(anchors))
        return KernelFeaturesModel(self.features, self.output, lambda x: kernel(x, anchors) @ rescale)


class KernelFeaturesModel(Model):
    def __init__(self, features, output, function):
        super().__init__()
        self.features, self.output, self.function = features, output, function

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.output, vector_map(self.function, self.features))


class SupportVectorMachine(Estimator):
    """Margin classifier of any number of classes; kernels go through ``KernelFeatures``.

    ``cost`` weighs the squared hinge loss of every row, for every kernel. ``components`` is the number of
    random features or landmarks: the kernel is approximated with an error that falls as one over its root.
    """

    def __init__(
        self, classes, kernel="sigmoid", cost=1.0, gamma=0.1, degree=3, coef0=0.0, components=200,
        max_iter=200, tol=1e-3, features="features", label="label", seed=0,
    ):
        super().__init__()
        if kernel not in KERNELS:
            raise ValueError(f"kernel {kernel} is not one of {', '.join(KERNELS)}")
        self.classes, self.kernel, self.cost, self.max_iter, self.tol = classes, kernel, float(cost), max_iter, tol
        self.gamma, self.degree, self.coef0, self.components = gamma, degree, coef0, components
        self.features, self.label, self.seed = features, label, seed

    def _fit(self, df: DataFrame) -> SupportVectorMachineModel:
        mapping = None
        df = df.select(self.features, self.label)
        if self.kernel != "linear":
            mapping = KernelFeatures(
                self.kernel, self.gamma, self.degree, self.coef0, self.components, self.features, seed=self.seed
            ).fit(df)
        return SupportVectorMachineModel(mapping, self._hinge(mapping.function if mapping else None).fit(df))

    def _hinge(self, mapping=None) -> SquaredHinge:
        return SquaredHinge(self.classes, self.cost, self.max_iter, self.tol, self.features, self.label, mapping)

    def fit_parts(self, df: DataFrame, parts: Sequence[Column], costs: Sequence[float] | None = None) -> list[SupportVectorMachineModel]:
        """A model for each part of the rows, a condition; linear machines share their passes, a kernel has features by part."""
        if self.kernel == "linear":
            return [SupportVectorMachineModel(None, m) for m in self._hinge().fit_parts(df, parts, costs)]
        if costs is not None:
            raise ValueError("only linear machines of several costs are fitted together")
        return [self.fit(df.where(p)) for p in parts]


class SupportVectorMachineModel(Model):
    """Adds ``prediction`` and ``rawPrediction`` (one margin per class)."""

    def __init__(self, mapping, fitted):
        super().__init__()
        self.mapping, self.fitted = mapping, fitted

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df)


class CalibratedMargins(Estimator):
    """A margin classifier with probabilities: margins of held-out rows calibrate a logistic model.

    The margin model is then fitted again on all rows, a linear one in the same passes.
    """

    def __init__(self, base: Estimator, key: str, label="label", holdout=0.2, seed=0):
        super().__init__()
        self.base, self.key, self.label, self.holdout, self.seed = base, key, label, holdout, seed

    def _fit(self, df: DataFrame) -> CalibratedMarginsModel:
        return self.fit_parts(df, [F.lit(True)])[0]

    def fit_parts(self, df: DataFrame, parts: Sequence[Column]) -> list[CalibratedMarginsModel]:
        """A model for each part of the rows, a condition."""
        held = uniform_hash(derived_seed(self.seed, "calibration"), self.key) < F.lit(self.holdout)
        wanted = [p & inside for p in parts for inside in (~held, F.lit(True))]
        together = isinstance(self.base, SupportVectorMachine)
        fitted = self.base.fit_parts(df, wanted) if together else [self.base.fit(df.where(w)) for w in wanted]
        models = []
        for part, without, whole in zip(parts, fitted[::2], fitted[1::2]):
            margins = without.transform(df.where(part & held))
            calibration = LogisticRegression(
                featuresCol="rawPrediction", labelCol=self.label, rawPredictionCol="_logit", predictionCol="_calibrated"
            ).fit(margins.select("rawPrediction", self.label))
            models.append(CalibratedMarginsModel(whole, calibration))
        return models


class CalibratedMarginsModel(Model):
    def __init__(self, fitted: Model, calibration: Model):
        super().__init__()
        self.fitted, self.calibration = fitted, calibration

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = self.calibration.transform(self.fitted.transform(df).drop("prediction"))
        return scored.withColumnRenamed("_calibrated", "prediction").drop("rawPrediction", "_logit")


__all__ = [
    "KERNELS",
    "KERNEL_DEFAULTS",
    "CalibratedMargins",
    "KernelFeatures",
    "SupportVectorMachine",
]

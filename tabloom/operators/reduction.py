"""Principal components, linear discriminants and clustering reports.

Everything here is fitted from p x p or per-class statistics; rows stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.blocks import summed, vector_map
from tabloom.session import dealt, keep


class PrincipalComponents(Estimator):
    """PCA that keeps ``k`` components or the fewest that explain ``variance_ratio``.

    The ratio wins when both are given. Input is centred on the fitting data. The largest
    loading of every component is positive, which fixes the otherwise free sign.
    """

    def __init__(self, features="features", output="scores", k: int | None = None, variance_ratio: float | None = None):
        super().__init__()
        if k is None and variance_ratio is None:
            raise ValueError("give k or variance_ratio")
        self.features, self.output, self.k, self.variance_ratio = features, output, k, variance_ratio

    def _fit(self, df: DataFrame) -> PrincipalComponentsModel:
        width = df.select(self.features).first()[0].size
        centre = StandardScaler(withMean=True, withStd=False, inputCol=self.features, outputCol="_centred").fit(df)
        wanted = width if self.variance_ratio is not None else min(self.k, width)
        pca = PCA(k=wanted, inputCol="_centred", outputCol="_rotated").fit(centre.transform(df))
        shares = pca.explainedVariance.toArray()
        if self.variance_ratio is not None:
            reached = np.nonzero(np.cumsum(shares) >= self.variance_ratio - 1e-12)[0]
            wanted = int(reached[0]) + 1 if len(reached) else width
        loadings = pca.pc.toArray()[:, :wanted]
        largest = np.argmax(np.abs(loadings), axis=0)
        signs = np.where(loadings[largest, np.arange(wanted)] < 0, -1.0, 1.0)
        stages = [
            centre,
            pca,
            VectorSlicer(inputCol="_rotated", outputCol="_kept", indices=list(range(wanted))),
            ElementwiseProduct(scalingVec=Vectors.dense(signs), inputCol="_kept", outputCol=self.output),
        ]
        return PrincipalComponentsModel(stages, loadings * signs, shares, wanted)


class PrincipalComponentsModel(Model):
    def __init__(self, stages, components: np.ndarray, shares: np.ndarray, k: int):
        super().__init__()
        self.stages, self.components, self.shares, self.k = stages, components, shares, k

    def _transform(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        return df.drop("_centred", "_rotated", "_kept")

    def variance(self, df: DataFrame) -> DataFrame:
        """Share and cumulative share of variance per component, kept or not."""
        rows = [(i + 1, float(s)) for i, s in enumerate(self.shares)]
        table = df.sparkSession.createDataFrame(rows, "component int, share double")
        upto = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumn("cumulative", F.sum("share").over(upto))


def explained_variance(df: DataFrame, features: str = "features", components: int = 50) -> DataFrame:
    """Variance shares of the first components of a prepared matrix (at least two columns)."""
    width = df.select(features).first()[0].size
    if width < 2:
        raise ValueError("at least two columns are needed")
    model = PrincipalComponents(features, k=min(components, width)).fit(df)
    return model.variance(df)


def covariance_matrix(df: DataFrame, features: str = "features") -> np.ndarray:
    """Sample covariance on the driver, p x p; one pass for correlations, one for deviations."""
    deviations = df.select(Summarizer.std(F.col(features))).first()[0].toArray()
    correlation = Correlation.corr(df.select(features), features).first()[0].toArray()
    return np.nan_to_num(correlation) * np.outer(deviations, deviations)


def covariance_entries(df: DataFrame, features: str = "features") -> DataFrame:
    """Upper triangle of the covariance matrix as rows ``i, j, covariance`` (zero-based)."""
    matrix = covariance_matrix(df, features)
    width = matrix.shape[0]
    rows = [(i, j, float(matrix[i, j])) for i in range(width) for j in range(i, width)]
    return df.sparkSession.createDataFrame(rows, "i int, j int, covariance double")


def class_means(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Rows and mean vector per class, one grouped pass."""
    summary = Summarizer.metrics("count", "mean").summary(F.col(features))
    return df.groupBy(label).agg(summary.alias("_s")).select(label, F.col("_s.count").alias("n"), F.col("_s.mean").alias("mean"))


def _within_scatter(df: DataFrame, label: str, features: str, place: dict, means: np.ndarray) -> np.ndarray:
    """Sum over rows of the outer product of the distance to the own class mean: no total minus between."""
    width = means.shape[1]
    names = F.array(*[F.lit(v) for v in place])
    rows = df.select(vector_to_array(features).alias("x"), (F.array_position(names, F.col(label)) - 1).alias("y"))

    def add(total, batch):
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        away = x - means[batch.column(1).to_numpy(zero_copy_only=False).astype("int64")]
        total += (away.T @ away).ravel()

    return summed(rows, add, width * width).reshape(width, width)


class LinearDiscriminants(Estimator):
    """Supervised projection that separates classes; at most K - 1 dimensions exist."""

    def __init__(self, features="features", label="label", output="scores", out_dim: int | None = None, ridge: float = 1e-8):
        super().__init__()
        self.features, self.label, self.output = features, label, output
        self.out_dim, self.ridge = out_dim, ridge

    def _fit(self, df: DataFrame) -> LinearDiscriminantsModel:
        df = df.where(F.col(self.label).isNotNull())
        groups = class_means(df, self.label, self.features).collect()
        counts = np.array([g["n"] for g in groups], dtype=float)
        means = np.array([g["mean"].toArray() for g in groups])
        total, centre = counts.sum(), counts @ means / counts.sum()
        away = means - centre
        between = (away * counts[:, None]).T @ away
        place = {g[self.label]: i for i, g in enumerate(groups)}
        within = _within_scatter(df, self.label, self.features, place, means)
        width = within.shape[0]
        within = within + np.eye(width) * self.ridge * max(np.trace(within) / width, 1e-300)
        # whiten by the within-class scatter, then rotate to the directions of the class means
        values, vectors = np.linalg.eigh(within)
        whiten = vectors / np.sqrt(np.maximum(values, np.finfo(float).tiny))
        spread, rotation = np.linalg.eigh(whiten.T @ between @ whiten)
        keep = min(self.out_dim or len(groups) - 1, len(groups) - 1, width)
        order = np.argsort(spread)[::-1][:keep]
        weights = whiten @ rotation[:, order] * np.sqrt(total - len(groups))
        largest = np.argmax(np.abs(weights), axis=0)
        weights = weights * np.where(weights[largest, np.arange(keep)] < 0, -1.0, 1.0)
        return LinearDiscriminantsModel(self.features, self.output, centre, weights, spread[order])


class LinearDiscriminantsModel(Model):
    def __init__(self, features, output, centre, weights, ratios):
        super().__init__()
        self.features, self.output = features, output
        self.centre, self.weights, self.ratios = centre, weights, ratios

    def _transform(self, df: DataFrame) -> DataFrame:
        centre, weights = self.centre, self.weights
        return df.withColumn(self.output, vector_map(lambda x: (x - centre) @ weights, self.features))


def points_by_class(df: DataFrame, scores: str, label: str) -> DataFrame:
    """The first two scores and the class of every row, for a class-coloured plot."""
    s = vector_to_array(scores)
    return df.select(s[0].alias("pc1"), s[1].alias("pc2"), F.col(label).alias("label"))


def kmeans_report(
    df: DataFrame,
    key: str,
    features: str = "features",
    k: int = 8,
    max_iter: int = 200,
    seed: int = 0,
    project: bool = True,
) -> dict[str, DataFrame]:
    """Clusters of a prepared matrix: fit summary, sizes with shares, and a 2-D projection."""
    width = df.select(features).first()[0].size
    rows = keep(dealt(df.select(features), df.count(), width))
    model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=features, predictionCol="cluster", solver="block").fit(rows)
    found, summary = model.summary.clusterSizes, model.summary
    total = sum(found)
    spark = df.sparkSession
    sizes = [(i, int(n), 100.0 * n / total if total else 0.0) for i, n in enumerate(found)]
    fit = [(bool(summary.numIter < max_iter), int(summary.numIter), float(summary.trainingCost))]
    report = {
        "fit": spark.createDataFrame(fit, "converged boolean, iterations int, cost double"),
        "sizes": spark.createDataFrame(sizes, "cluster int, n bigint, pct double"),
    }
    if project:
        projected = PrincipalComponents(features, "_p", k=2).fit(rows).transform(model.transform(df))
        p = vector_to_array("_p")
        report["points"] = projected.select(key, "cluster", p[0].alias("pc1"), p[1].alias("pc2"))
    rows.unpersist()
    return report


def reduce_features(
    train: DataFrame, others: Sequence[DataFrame], kind: str | None, features: str, label: str, output: str, **settings
) -> tuple[list[DataFrame], Model | None]:
    """Fit a reduction on the training rows and apply the same model everywhere."""
    if kind is None:
        return [train, *others], None
    if kind == "pca":
        estimator = PrincipalComponents(features, output, **settings)
    elif kind == "lda":
        estimator = LinearDiscriminants(features, label, output, **settings)
    else:
        raise ValueError(f"unknown reduction {kind}")
    model = estimator.fit(train)
    return [model.transform(d) for d in (train, *others)], model

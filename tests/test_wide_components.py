"""Components of wide tables against a dense decomposition."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F
from test_models import frame

from tabloom.operators.reduction import explained_variance
from tabloom.operators.wide_components import WidePrincipalComponents


def dense(x):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    values, vectors = values[::-1], vectors[:, ::-1]
    return values / values.sum(), vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)


@pytest.fixture(scope="module")
def sixty():
    rng = np.random.default_rng(2)
    return rng.normal(0, 1, (500, 60)) @ rng.normal(0, 1, (60, 60)) + 5


def test_equal_to_a_dense_decomposition(spark, sixty):
    df = frame(spark, sixty, np.zeros(500)).repartition(5)
    shares, vectors = dense(sixty)
    model = WidePrincipalComponents(k=6).fit(df)
    assert np.allclose(model.shares, shares[:6], atol=1e-9) and np.allclose(model.components, vectors[:, :6], atol=1e-5)
    scores = np.array([r[0] for r in model.transform(df).orderBy("id").select(vector_to_array("scores")).collect()])
    assert np.allclose(scores, (sixty - sixty.mean(axis=0)) @ vectors[:, :6], atol=1e-3)
    known = [r["share"] for r in explained_variance(df, components=6).orderBy("component").collect()]
    assert np.allclose([r["share"] for r in model.variance(df).orderBy("component").collect()], known, atol=1e-6)


def test_fewest_components_of_a_ratio(spark, sixty):
    shares, vectors = dense(sixty)
    df = frame(spark, sixty, np.zeros(500))
    model = WidePrincipalComponents(variance_ratio=0.9).fit(df)
    assert model.k == int(np.nonzero(np.cumsum(shares) >= 0.9)[0][0]) + 1 and np.allclose(model.components, vectors[:, : model.k], atol=1e-4)
    everything = WidePrincipalComponents(variance_ratio=1.0).fit(df)
    assert everything.k == 60 and np.isclose(everything.shares.sum(), 1)


def test_thousands_of_columns_without_a_square_matrix(spark):
    angle, j = F.col("id") * 0.1, F.sequence(F.lit(0), F.lit(4999))
    noise = F.transform(j, lambda i: (3 * F.cos(angle) * F.sin(i * 0.01) + 2 * F.sin(angle * 3.7) * F.cos(i * 0.02) + F.pmod(F.xxhash64("id", i), F.lit(1000)) / 1e4))
    df = spark.range(300).select("id", array_to_vector(noise).alias("features")).cache()
    model = WidePrincipalComponents(k=2).fit(df)
    x = np.array([r[0] for r in df.orderBy("id").select(vector_to_array("features")).collect()])
    strength = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2
    assert np.allclose(model.shares, strength[:2] / strength.sum(), atol=1e-9) and model.scans <= 6
    df.unpersist()


def test_repeated_values_nulls_and_narrow_tables(spark):
    # twenty equal variances, more than any block meets at once, and columns that never vary
    x = np.vstack([np.eye(20), -np.eye(20)])
    rows = frame(spark, np.hstack([x, np.ones((40, 5))]), np.zeros(40))
    holed = rows.unionByName(rows.limit(3).withColumn("features", F.lit(None).cast(rows.schema["features"].dataType)))
    model = WidePrincipalComponents(k=25).fit(holed)
    assert np.allclose(model.shares, [0.05] * 20 + [0] * 5) and model.transform(holed).count() == 40
    copies = WidePrincipalComponents(k=3).fit(rows.limit(1).crossJoin(spark.range(50).select(F.lit(1).alias("one"))))
    assert np.allclose(copies.shares, 0) and copies.components.shape == (25, 3)
    with pytest.raises(ValueError, match="no rows"):
        WidePrincipalComponents(k=1).fit(rows.limit(0))
    with pytest.raises(ValueError, match="ratio"):
        WidePrincipalComponents()

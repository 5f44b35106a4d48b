"""Symmetric boosting against a plain version, ordered statistics against a loop."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import blobs, frame, share

from tabloom.functions.expressions import order_key
from tabloom.models.boosting import SymmetricBoosting, ordered_statistics
from tabloom.models.registry import Columns, get_model


def plain(x, y, classes, iterations, rate, depth, l2, fresh):
    """Class probabilities of fresh rows, by looking at every cut for every level."""
    score, out = np.zeros((len(x), classes)), np.zeros((len(fresh), classes))
    for _ in range(iterations):
        p = np.exp(score) / np.exp(score).sum(axis=1, keepdims=True)
        g, h = np.eye(classes)[y] - p, p * (1 - p)
        leaf, other = np.zeros(len(x), int), np.zeros(len(fresh), int)
        for level in range(depth):
            best = None
            for f in range(x.shape[1]):
                for t in np.unique(x[:, f])[:-1]:
                    parts = leaf + ((x[:, f] > t).astype(int) << level)
                    gain = sum((g[parts == k].sum(axis=0) ** 2 / (h[parts == k].sum(axis=0) + l2)).sum() for k in set(parts))
                    if best is None or gain > best[0] * (1 + 1e-12):
                        best = gain, f, t
            leaf = leaf + ((x[:, best[1]] > best[2]).astype(int) << level)
            other = other + ((fresh[:, best[1]] > best[2]).astype(int) << level)
        values = np.array([rate * g[leaf == k].sum(axis=0) / (h[leaf == k].sum(axis=0) + l2) for k in range(1 << depth)])
        score, out = score + values[leaf], out + values[other]
    return np.exp(out) / np.exp(out).sum(axis=1, keepdims=True)


@pytest.mark.parametrize("rate,depth", [(0.3, 2), (0.1, 3)])
def test_equal_to_a_plain_version(spark, rate, depth):
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 7, (150, 3)) / 2, rng.integers(0, 3, 150)
    fresh = rng.integers(0, 7, (60, 3)) / 2
    model = SymmetricBoosting(3, 4, rate, depth).fit(frame(spark, x, y).repartition(3))
    got = np.array([r[0].toArray() for r in model.transform(frame(spark, fresh, np.zeros(60))).orderBy("id").select("probability").collect()])
    assert np.allclose(got, plain(x, y, 3, 4, rate, depth, 3.0, fresh), atol=1e-9)
    assert len(model.trees) == 4 and all(len(t.features) == depth for t in model.trees)


def test_one_model_for_three_classes(spark):
    x, y = blobs(3)
    rows = frame(spark, x, y)
    model = get_model("CatBoost", {"iterations": 6, "depth": 3, "learning_rate": 0.5}, Columns(3)).fit(rows)
    assert share(model.transform(rows)) > 0.95 and model.trees[0].values.shape == (8, 3)
    odd = rows.unionByName(rows.limit(20).withColumn("label", F.lit(None).cast("double")))
    again = get_model("CatBoost", {"iterations": 2, "depth": 3}, Columns(3)).fit(odd)
    assert np.allclose(again.trees[0].values * 5, model.trees[0].values)
    assert SymmetricBoosting(2).fit(frame(spark, np.ones((4, 2)), np.array([0, 1, 1, 1]))).trees == []
    with pytest.raises(ValueError, match="levels"):
        SymmetricBoosting(2, depth=0)


def test_ordered_statistics_equal_a_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None]), None if i % 11 == 0 else float(rng.integers(0, 2))) for i in range(400)]
    rows = [(i, None if c is None else str(c), t) for i, c, t in rows]
    df = spark.createDataFrame(rows, "id int, kind string, bought double").repartition(5)
    keys = {r["id"]: r["k"] for r in df.select("id", order_key(3, "id").alias("k")).collect()}
    sums, wanted = collections.defaultdict(lambda: [0.0, 0]), {}
    for i, c, t in sorted(rows, key=lambda r: keys[r[0]]):
        wanted[i] = (sums[c][0] + 0.25 * 2) / (sums[c][1] + 2)
        if t is not None:
            sums[c][0] += t
            sums[c][1] += 1
    got = ordered_statistics(df, "kind", "bought", ["id"], 3, 0.25, 2.0)
    assert got.columns == [*df.columns, "statistic"]
    assert {r["id"]: pytest.approx(r["statistic"]) for r in got.collect()} == wanted

"""Adam networks against a plain version, the published settings, and training in shared scans."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from test_models import blobs, frame, parts, share

from tabloom.functions.blocks import packed
from tabloom.models.adam import TEST, TRAIN, VALIDATION, Network, confusion_together, network_blocks, train_together
from tabloom.models.network import NeuralNetwork
from tabloom.models.registry import Columns, get_model
from tabloom.operators.splits import holdout, stratified_kfold
from tabloom.plans import approaches as A
from tabloom.plans import evaluation as V


@pytest.fixture(scope="module")
def three(spark):
    return holdout(frame(spark, *blobs(3)), "id", 0.25, 1).cache()


def forward(x, layers):
    outputs = [x]
    for i, (w, b) in enumerate(layers):
        z = outputs[-1] @ w + b
        outputs.append(1 / (1 + np.exp(-z)) if i < len(layers) - 1 else np.exp(z) / np.exp(z).sum(axis=1, keepdims=True))
    return outputs


def unpacked(flat, shapes):
    layers, at = [], 0
    for a, b in shapes:
        layers.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return layers


def loss(flat, shapes, x, y):
    return -np.log(forward(x, unpacked(flat, shapes))[-1][np.arange(len(y)), y]).mean()


def test_every_step_equals_plain_adam(spark):
    x, y = blobs(3, 40)
    rows = frame(spark, x, y).repartition(3)
    network = Network(4, [5, 3], 3, 0.05, max_epochs=6, seed=4)
    flat, shapes = network.weights.copy(), network.shapes()
    train_together(packed(rows, "features", "label", F.array(F.lit(TRAIN)), rows=7), [network])
    first = second = np.zeros_like(flat)
    history = [loss(flat, shapes, x, y)]
    for step in range(1, 7):
        # central differences, so that nothing of the library's gradient is repeated here
        gradient = np.array([(loss(flat + e, shapes, x, y) - loss(flat - e, shapes, x, y)) / 2e-6 for e in np.eye(len(flat)) * 1e-6])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        flat = flat - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        history.append(loss(flat, shapes, x, y))
    assert np.allclose(network.best, flat, atol=2e-5)
    assert np.allclose([h[1] for h in network.history], history, atol=1e-5) and [h[0] for h in network.history] == list(range(7))


def test_published_settings_learn_in_shared_scans(spark, three):
    folds = stratified_kfold(three.drop("split"), "id", "label", 2, 3)
    configs = [("ANN", dict(c)) for c in A.ANN_CONFIGS]
    assert len(configs) == 8 and {c["learning_rate"] for _, c in configs} == {0.001}
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup(None))
    counts = V.fold_counts(folds, configs, Columns(3), ["a", "b", "c"], parallelism=1)
    spent = len(jobs.getJobIdsForGroup(None)) - before
    rows = counts.collect()
    for index in range(8):
        mine = [r for r in rows if r["config_index"] == index]
        assert sum(r["n"] for r in mine) == three.count()
        assert sum(r["n"] for r in mine if r["label"] == r["prediction"]) >= 0.95 * three.count(), configs[index]
    assert spent < 3 * 301 + 20  # the epochs of one network, whatever the number of settings and folds


def test_patience_and_best_weights(spark):
    rng = np.random.default_rng(0)
    rows = frame(spark, rng.normal(size=(60, 3)), rng.integers(0, 2, 60))  # noise: the validation loss soon rises
    network = Network(3, [8], 2, 0.3, max_epochs=400, patience=5, seed=1)
    blocks = packed(rows, "features", "label", F.array(F.when(F.col("id") % 3 == 0, VALIDATION).when(F.col("id") % 3 == 1, TEST).otherwise(TRAIN)))
    train_together(blocks, [network])
    losses = [h[2] for h in network.history]
    assert len(losses) < 400 and losses.index(min(losses[1:])) == len(losses) - 6 and all(h[3] is not None for h in network.history)
    counts = confusion_together(blocks, [network])
    assert counts.sum() == 20 and counts[0, 2].sum() == 0


def test_smallest_loss_and_missing_labels(spark, three):
    train, test = parts(three)
    fitted = NeuralNetwork(3, [8], learning_rate=0.1, max_epochs=200, min_loss=0.3).fit(train)
    assert fitted.history[-1][1] <= 0.3 < fitted.history[-2][1]
    unlabelled = test.withColumn("label", F.lit(None).cast("double"))
    again = NeuralNetwork(3, [8], learning_rate=0.1, max_epochs=200, min_loss=0.3).fit(train.unionByName(unlabelled))
    assert np.allclose(again.weights, fitted.weights)
    with pytest.raises(ValueError, match="training rows"):
        NeuralNetwork(3, [8], learning_rate=0.1).fit(unlabelled)


def test_validation_part_by_ratio(three):
    train, test = parts(three)
    fitted = get_model("ANN", {"topology": [16], "learning_rate": 0.05, "max_epochs": 80, "validation_ratio": 0.2}, Columns(3)).fit(train)
    assert share(fitted.transform(test)) >= 0.95 and fitted.history[-1][2] is not None
    rows = fitted.losses(train).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == list(range(len(rows))) and rows[-1]["train_loss"] < rows[0]["train_loss"]


def test_equal_rows_are_dealt_evenly(spark):
    from tabloom.session import dealt

    rows = spark.range(1000).select(array_to_vector(F.array(F.lit(1.0))).alias("features"), F.lit(0.0).alias("label"))
    sizes = dealt(rows, 1000, 1, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 200


def test_equal_rows_are_one_row_that_counts_more(spark):
    """An epoch passes over different rows only, with the losses, weights and counts of all of them."""
    x = np.repeat(np.eye(3), [500, 300, 200], axis=0)
    rows = frame(spark, x, np.repeat([0, 1, 1], [500, 300, 200])).repartition(3)
    roles = F.array(F.when(F.col("id") % 5 == 0, VALIDATION).when(F.col("id") % 5 == 1, TEST).otherwise(TRAIN))
    plain, weighed = (Network(3, [4], 2, 0.05, max_epochs=5, seed=2) for _ in range(2))
    every = packed(rows, "features", "label", roles)
    different = network_blocks(rows, "features", "label", roles, [weighed])
    assert different.agg(F.sum("n")).first()[0] == 9
    train_together(every, [plain])
    train_together(different, [weighed])
    assert np.allclose(plain.best, weighed.best, atol=1e-12)
    assert np.allclose(np.array(plain.history, float), np.array(weighed.history, float), atol=1e-12)
    assert (confusion_together(every, [plain]) == confusion_together(different, [weighed])).all()
    assert confusion_together(different, [weighed]).sum() == 200

"""Trees grown together against plain trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import blobs, frame, share

from tabloom.models.adaboost import cut_points
from tabloom.models.grown import GrownTree, grown_trees
from tabloom.models.registry import Columns, get_model
from tabloom.session import TASKS_PER_CORE


def plain_tree(x, y, classes, depth, least):
    """Predictions of a tree grown by looking at every cut between neighbouring values."""
    counts = np.bincount(y, minlength=classes)
    best = None
    if depth and counts.max() < len(y):
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for a, b in zip(values, values[1:]):
                low = x[:, f] <= a
                if min(low.sum(), (~low).sum()) < least:
                    continue
                purity = sum((np.bincount(y[side], minlength=classes) ** 2).sum() / side.sum() for side in (low, ~low))
                if best is None or purity > best[0] * (1 + 1e-12):
                    best = purity, f, a + (b - a) / 2
    if best is None:
        return lambda rows: np.full(len(rows), counts.argmax())
    low = x[:, best[1]] <= best[2]
    sides = [plain_tree(x[s], y[s], classes, depth - 1, least) for s in (low, ~low)]
    return lambda rows: np.where(rows[:, best[1]] <= best[2], sides[0](rows), sides[1](rows))


@pytest.mark.parametrize("depth,least", [(-1, 1), (4, 1), (-1, 7), (0, 1)])
def test_equal_to_a_plain_tree(spark, depth, least):
    rng = np.random.default_rng(depth + 5)
    x, y = rng.integers(0, 12, (220, 3)) / 4, rng.integers(0, 3, 220)
    fresh = rng.integers(0, 12, (100, 3)) / 4
    wanted = plain_tree(x, y, 3, depth, least)(fresh).tolist()
    for local in (10_000, 30):  # all at once, or large nodes by histograms; few values, so that bins lose nothing
        model = GrownTree(3, depth, least, local=local).fit(frame(spark, x, y).repartition(3))
        got = model.transform(frame(spark, fresh, np.zeros(100))).orderBy("id").collect()
        assert [int(r["prediction"]) for r in got] == wanted
        assert all(abs(sum(r["probability"]) - 1) < 1e-9 for r in got)


def test_unlimited_depth_ends_at_pure_leaves(spark):
    x = np.arange(64.0)[:, None]
    y = np.arange(64) % 2  # needs a leaf for every row
    rows = frame(spark, x, y)
    model = get_model("DT", {"max_depth": -1}, Columns(2)).fit(rows)
    assert share(model.transform(rows)) == 1.0
    assert sum(f < 0 for f in model.trees[0].feature) == 64
    deep = get_model("DT", {"max_depth": 70}, Columns(2)).fit(rows)
    assert share(deep.transform(rows)) == 1.0
    xor = frame(spark, np.array([[0, 0], [0, 1], [1, 0], [1, 1]] * 5), np.array([0, 1, 1, 0] * 5))
    assert share(GrownTree(2, -1).fit(xor).transform(xor)) == 1.0  # the first cut has no gain


def test_trees_of_one_growth_equal_those_grown_alone(spark):
    x, y = blobs(3, 300)
    rows = frame(spark, x, y)
    weights = [F.when(F.col("id") % 3 == k, 0).otherwise(1 + F.col("id") % 2) for k in range(3)]
    together = grown_trees(rows, weights, 3, -1, 4, "features", "label", local=60)
    for k in range(3):
        alone = grown_trees(rows, [weights[k]], 3, -1, 4, "features", "label", local=60)[0]
        assert (alone.feature, alone.threshold, alone.low) == (together[k].feature, together[k].threshold, together[k].low)


def test_depth_of_a_deeper_tree_is_the_shallow_tree(spark):
    x, y = blobs(3, 200)
    rows = frame(spark, x, y)
    deep = grown_trees(rows, [F.lit(1)], 3, 9, 2, "features", "label")[0]
    flat = grown_trees(rows, [F.lit(1)], 3, 2, 2, "features", "label")[0]
    from tabloom.models.grown import scorer

    assert np.allclose(scorer([deep], 2)(x), scorer([flat])(x))


def test_rows_without_label_or_weight(spark):
    x, y = blobs(2, 80)
    rows = frame(spark, x, y)
    odd = rows.withColumn("label", F.lit(None).cast("double"))
    one, both = (grown_trees(d, [F.lit(1)], 2, 3, 1, "features", "label")[0] for d in (rows, rows.unionByName(odd)))
    assert (one.feature, one.threshold) == (both.feature, both.threshold)
    empty = grown_trees(rows, [F.lit(0)], 2, 3, 1, "features", "label")[0]
    assert empty.feature == [-1]


def test_cut_points_merge_few_sketches(spark):
    """One task merges the sketches, so their number must not follow the number of partitions."""
    context = spark.sparkContext
    most = TASKS_PER_CORE * context.defaultParallelism
    rows = spark.range(4_000).select(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double")).alias("x")).repartition(2 * most)
    context.setJobGroup("cut points", "")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cuts = cut_points(rows, 2, 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("cut points") for s in tracker.getJobInfo(j).stageIds]
    tasks = [tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)]
    assert tasks and max(t for t in tasks) <= most
    assert [len(c) for c in cuts] == [7, 6]
    assert np.abs(cuts[0] - 500 * np.arange(1, 8)).max() <= 2

"""Kernel machines on the kernel itself against a plain solver of the dual problem."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_models import blobs, frame, share

from tabloom.models.kernel_dual import ExactKernelMachine, kernel_function
from tabloom.models.registry import Columns, get_model


def plain(kernel, y, cost, rounds=4000):
    """Multipliers and bias, by sweeps over all pairs of rows in random order until nothing moves."""
    rng = np.random.default_rng(0)
    n, a, f = len(y), np.zeros(len(y)), np.zeros(len(y))
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(n):
            v = y - f
            up, low = np.where(y > 0, a < cost, a > 0), np.where(y > 0, a > 0, a < cost)
            j = int(np.argmin(np.where(low, v, np.inf))) if up[i] else int(np.argmax(np.where(up, v, -np.inf)))
            i, j = (i, j) if up[i] else (j, i)
            if v[i] - v[j] <= 1e-10:
                continue
            step = (v[i] - v[j]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
            step = min(step, cost - a[i] if y[i] > 0 else a[i], a[j] if y[j] > 0 else cost - a[j])
            a[i], a[j] = a[i] + y[i] * step, a[j] - y[j] * step
            a[np.abs(a) < 1e-12], a[np.abs(a - cost) < 1e-12] = 0, cost
            f += step * (kernel[:, i] - kernel[:, j])
            moved = max(moved, step)
        if moved < 1e-10:
            break
    free = (a > 0) & (a < cost)
    return a * y, (y - f)[free].mean()


@pytest.fixture(scope="module")
def rings():
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (160, 2))
    y = (np.hypot(*x.T) + rng.normal(0, 0.25, 160) > 1.1).astype(int)
    return x, y


def margins(model, rows):
    return np.array([r[0][0] for r in model.transform(rows).orderBy("id").select("rawPrediction").collect()])


@pytest.mark.parametrize("kind,gamma,coef0,cost", [("rbf", 0.7, 0.0, 2.0), ("poly", 0.5, 1.0, 0.5), ("linear", 1.0, 0.0, 1.0)])
def test_equal_to_a_plain_solver(spark, rings, kind, gamma, coef0, cost):
    x, y = rings
    kernel = kernel_function(kind, gamma, 2, coef0)
    signed, bias = plain(kernel(x, x), np.where(y == 0, 1.0, -1.0), cost)
    fresh = np.random.default_rng(4).normal(0, 1, (50, 2))
    # a small working set, so that many exchanges are needed
    fit = ExactKernelMachine(2, kind, cost, gamma, 2, coef0, tol=1e-5, working=40)
    model = fit.fit(frame(spark, x, y).repartition(3))
    assert np.allclose(margins(model, frame(spark, fresh, np.zeros(50))), kernel(fresh, x) @ signed + bias, atol=2e-3)
    report = model.machines().first()
    assert report["violation"] <= 1e-5 and 0 <= report["gap"] + 1e-9 < 1e-2
    # multipliers are not unique where the kernel has a low rank, the optimum is
    assert np.isclose(report["dual"], np.abs(signed).sum() - signed @ kernel(x, x) @ signed / 2, rtol=1e-5)


def test_copies_count_and_partitions_do_not(spark, rings):
    x, y = rings
    rows = frame(spark, x, y)
    heavy = rows.unionByName(rows.where("id % 3 = 0")).unionByName(rows.where("id = 5").crossJoin(spark.range(300).select(F.lit(1))).select(rows.columns))
    times = np.array([1 + (i % 3 == 0) + 300 * (i == 5) for i in range(160)])
    fit = ExactKernelMachine(2, "rbf", 1.0, 0.7, tol=1e-6, working=32)
    one = margins(fit.fit(heavy.repartition(5)), rows)
    assert np.allclose(one, margins(fit.fit(heavy.coalesce(1)), rows), atol=1e-4)
    written_out = frame(spark, np.repeat(x, times, axis=0), np.repeat(y, times))
    assert np.allclose(one, margins(fit.fit(written_out), rows), atol=1e-4)


def test_joined_support_vectors_give_the_same_margins(spark, rings):
    x, y = rings
    rows = frame(spark, x, y)
    joined = ExactKernelMachine(2, "rbf", 1.0, 0.7, model_bytes=0).fit(rows)
    carried = ExactKernelMachine(2, "rbf", 1.0, 0.7).fit(rows)
    doubled = rows.unionByName(rows.limit(7))
    assert joined.transform(doubled).count() == 167
    assert np.allclose(margins(joined, rows), margins(carried, rows), atol=1e-6)


def test_classes_vote(spark):
    x, y = blobs(3)
    rows = frame(spark, x, y)
    model = get_model("SVC", {"exact": True, "kernel": "rbf", "gamma": 0.1}, Columns(3)).fit(rows)
    assert share(model.transform(rows)) > 0.95 and model.machines().count() == 3
    again = get_model("SVCProbabilistic", {"exact": True, "kernel": "sigmoid", "gamma": 0.02, "coef0": 0.1}, Columns(3)).fit(rows)
    assert share(again.transform(rows)) > 0.9


def test_missing_classes_and_empty_tables(spark):
    x, y = blobs(2)
    rows = frame(spark, x, y)
    odd = rows.unionByName(rows.limit(5).withColumn("label", F.lit(None).cast("double")))
    assert share(ExactKernelMachine(3, "rbf").fit(odd).transform(rows)) > 0.95
    only = ExactKernelMachine(2, "rbf").fit(rows.where("label = 1"))
    assert {r[0] for r in only.transform(rows).select("prediction").collect()} == {1.0}
    none = ExactKernelMachine(2, "rbf").fit(rows.limit(0))
    assert {r[0] for r in none.transform(rows).select("prediction").collect()} == {0.0}
    assert none.transform(rows.limit(0)).count() == 0


def test_an_unfinished_fit_warns(spark, rings):
    with pytest.warns(UserWarning, match="violation"):
        ExactKernelMachine(2, "rbf", 5.0, 0.7, tol=1e-6, max_iter=1, working=4).fit(frame(spark, *rings))
    with pytest.raises(ValueError, match="laplace"):
        ExactKernelMachine(2, "laplace")


def test_a_partition_offers_no_more_rows_than_are_taken(spark):
    """However many blocks a partition holds, it offers ``working / 2`` rows of a side, the worst of all its blocks."""
    x, y = [(i, i % 3) for i in range(3_000)], [i % 2 for i in range(3_000)]
    fit = ExactKernelMachine(2, kernel="linear", working=8)
    state = fit._blocks(frame(spark, x, y)).coalesce(1)
    assert state.count() > 1
    few, every = fit._offers(state), ExactKernelMachine(2, kernel="linear", working=8_000)._offers(state)
    assert few.groupBy("machine", "up").count().agg(F.max("count")).first()[0] == 4
    for up in (True, False):
        best = [(r["block"], r["place"]) for r in every.where(F.col("up") == up).orderBy(F.desc("score"), "block", "place").take(4)]
        assert best == [(r["block"], r["place"]) for r in few.where(F.col("up") == up).orderBy(F.desc("score"), "block", "place").collect()]

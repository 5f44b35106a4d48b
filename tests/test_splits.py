"""Exact sizes, coverage and independence from partitioning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.operators import splits as X
from tabloom.operators.quantiles import column_quantiles, exact_quantiles
from tabloom.operators.ranks import cut_keys


def sizes(df, column):
    return {r[0]: r[1] for r in df.groupBy(column).count().collect()}


@pytest.mark.parametrize("n,share,test", [(150, 0.2, 30), (208, 0.1, 21), (5, 0.5, 2), (7, 0.0, 0), (7, 1.0, 7)])
def test_holdout_sizes(spark, n, share, test):
    found = sizes(X.holdout(spark.range(n), "id", share, 3), "split")
    assert found.get("test", 0) == test and found.get("train", 0) == n - test


def test_holdout3_sizes(spark):
    assert sizes(X.holdout3(spark.range(150), "id", 0.2, 0.2, 1), "split") == {"train": 90, "validation": 30, "test": 30}
    with pytest.raises(ValueError):
        X.holdout3(spark.range(5), "id", 0.5, 0.5)


@pytest.mark.parametrize("limit", [10, 1_000_000])
def test_split_does_not_depend_on_layout(spark, limit):
    base = spark.range(3000)
    one = X.holdout(base.repartition(1), "id", 0.3, 5, rank_limit=limit)
    many = X.holdout(base.repartition(8), "id", 0.3, 5, rank_limit=1_000_000)
    assert sizes(one, "split") == {"train": 2100, "test": 900}
    assert one.join(many, ["id", "split"]).count() == 3000


def test_kfold_sizes(spark):
    assert sorted(sizes(X.kfold(spark.range(5), "id", 3), "fold").values()) == [1, 2, 2]


def test_stratified_folds_cover_every_class(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([0, 1, 0, 1, 1, 0])], "id int, y int")
    for r in X.stratified_kfold(df, "id", "y", 3).groupBy("fold").agg(F.collect_list("y").alias("y")).collect():
        assert sorted(r["y"]) == [0, 1]


def test_more_folds_than_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "b")], "id int, y string")
    folds = X.stratified_kfold(df, "id", "y", 10)
    assert folds.where("fold between 1 and 10").count() == 5
    assert folds.groupBy("y", "fold").count().where("count > 1").count() == 0


def test_mixed_labels_and_null_stratum(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "1"), (4, "a"), (5, None), (6, None)], "id int, y string")
    folds = X.stratified_kfold(df, "id", "y", 2)
    rows = {r["id"]: r["fold"] for r in folds.collect()}
    assert rows[1] != rows[4] and rows[5] != rows[6] and len(rows) == 6


def test_equal_keys_stay_together(spark):
    df = spark.range(900).select((F.col("id") % 3).alias("k"), "id")
    marked = X.holdout(df, "k", 0.34, 1, rank_limit=10)
    assert X.split_problems(marked, "k", "split", ["train", "test"]).count() == 0


def test_split_problems_are_found(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "other"), (3, "test")], "id int, split string")
    assert sorted(r["id"] for r in X.split_problems(df, "id", "split", ["train", "test"]).collect()) == [1, 2]


@pytest.mark.parametrize("n,limit", [(500, 7), (3000, 1_000_000)])
def test_sample_is_exact(spark, n, limit):
    df = spark.range(3000)
    assert X.sample_rows(df, "id", n, 2, rank_limit=limit).count() == min(n, 3000)
    assert X.sample_rows(df, "id", 10_000, 2).count() == 3000


def test_cut_keys_match_sorting(spark):
    from tabloom.functions.expressions import order_key

    df = spark.range(2000)
    keys = sorted(r[0] for r in df.select(order_key(4, "id")).collect())
    assert cut_keys(df, ["id"], 4, lambda n: [10, 500, n, 0], rank_limit=20) == {"": [keys[9], keys[499], keys[-1], ""]}


@pytest.mark.parametrize("limit", [20, 100_000])
def test_folds_within_any_number_of_strata(spark, limit):
    """3,000 strata of one to a few rows, one of a third of all rows and one without a name, as NTILE deals them."""
    from tabloom.functions.expressions import order_key

    kind = F.when(F.col("id") < 3000, F.lit(-1)).when(F.col("id") < 3020, F.lit(None)).otherwise(F.col("id") % 3000)
    df = spark.range(9000).withColumn("s", kind).repartition(6)
    ranked = df.withColumn("k", order_key(5, "id")).createOrReplaceTempView("strata_rows")
    wanted = {r["id"]: r["fold"] for r in spark.sql("SELECT id, NTILE(4) OVER (PARTITION BY s ORDER BY k) AS fold FROM strata_rows").collect()}
    got = X.kfold(df, "id", 4, 5, ["s"], rank_limit=limit)
    assert ranked is None and got.columns == ["id", "s", "fold"]
    assert {r["id"]: r["fold"] for r in got.collect()} == wanted
    assert X.kfold(df.limit(0), "id", 4, 5, ["s"]).count() == 0
    assert {r["fold"] for r in X.kfold(df, "id", 1, 5, ["s"]).collect()} == {1}


@pytest.mark.parametrize("limit", [1, 50, 10_000_000])
def test_quantiles_are_exact_on_skewed_data(spark, limit):
    """A third of the rows share one value, one group dominates, and tails are long."""
    rng = np.random.default_rng(0)
    values = np.concatenate([np.full(2000, 3.5), np.exp(rng.normal(0, 4, 3000)), -rng.exponential(1, 1000)])
    groups = np.where(rng.random(6000) < 0.9, "hot", "cold")
    rows = [(str(g), float(v)) for g, v in zip(groups, values)] + [("cold", None), ("hot", float("nan")), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = (0.0, 0.1, 0.33, 0.5, 0.66, 0.999, 1.0)
    got = {r["g"]: r for r in exact_quantiles(df, "v", probs, by=["g"], ranked=limit).collect()}
    for g in ("hot", "cold"):
        mine = values[groups == g]
        assert got[g]["n"] == len(mine)
        assert got[g]["q"] == pytest.approx(np.quantile(mine, probs).tolist())
    assert got[None]["q"] == pytest.approx(np.quantile([1.0, 2.0], probs).tolist())
    alone = exact_quantiles(df.where("g is not null"), "v", probs, ranked=limit).first()
    assert alone["q"] == pytest.approx(np.quantile(values, probs).tolist())


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert exact_quantiles(df, "v", (0.5,)).first()["q"] is None


@pytest.mark.parametrize("limit", [10, 10_000_000])
def test_column_quantiles_are_exact(spark, limit):
    rng = np.random.default_rng(2)
    hot = np.where(rng.random(4000) < 0.4, 1.5, rng.normal(0, 1, 4000))
    wide = np.exp(rng.normal(0, 5, 4000))
    rows = [(float(a), float(b), None, float("nan")) for a, b in zip(hot, wide)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(4)
    probs = (0.0, 0.25, 0.5, 0.75, 1.0)
    got = column_quantiles(df, df.columns, probs, limit)
    assert got["a"] == pytest.approx(np.quantile(hot, probs).tolist())
    assert got["b"] == pytest.approx(np.quantile(wide, probs).tolist())
    assert got["c"] == got["d"] == [None] * 5


def test_sample_columns(spark):
    names = [f"c{i}" for i in range(20)]
    chosen = X.sample_columns(names, 5, 1)
    assert len(chosen) == 5 and chosen == sorted(chosen, key=names.index) and X.sample_columns(names, 50) == names


def test_quantiles_of_groups_larger_than_the_sketch(spark):
    rng = np.random.default_rng(6)
    big = np.concatenate([rng.lognormal(0, 3, 25_000), np.repeat([1.0, 2.0], 9_000), -rng.lognormal(0, 3, 7_000)])
    few = rng.integers(0, 5, 30_000).astype(float)
    df = spark.createDataFrame([("big", float(v)) for v in big] + [("few", v) for v in few.tolist()] + [("one", 3.0)], "g string, v double").repartition(7)
    probs = (0.0, 0.001, 0.33, 0.5, 0.9, 0.9999, 1.0)
    for ranked in (1_000_000, 20):  # counted at once, or narrowed down
        got = {r["g"]: r["q"] for r in exact_quantiles(df, "v", probs, by=["g"], ranked=ranked).collect()}
        assert np.allclose(got["big"], np.quantile(big, probs), rtol=1e-12) and np.allclose(got["few"], np.quantile(few, probs))
        assert got["one"] == [3.0] * len(probs)


def test_split_starts_no_python_on_executors(spark):
    """Tables that the driver makes for a split are Arrow tables; a list of rows would be read by Python processes."""
    seen, make = [], type(spark).createDataFrame
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda self, data, *a, **k: seen.append(out := make(self, data, *a, **k)) or out)
        df = spark.range(300).withColumn("s", F.col("id") % 3)
        marked = X.stratified_kfold(X.holdout(df, "id", 0.2, 1), "id", "s", 2, 1)
        assert marked.groupBy("split").count().orderBy("split").collect() == [("test", 60), ("train", 240)]
    assert seen and all("ExistingRDD" not in d._jdf.queryExecution().executedPlan().toString() for d in seen)


def test_driver_table(spark):
    from tabloom.session import driver_table

    empty = driver_table(spark, [], "a string, b bigint")
    assert empty.dtypes == [("a", "string"), ("b", "bigint")] and empty.count() == 0
    assert driver_table(spark, [("x", None), (None, 2**40)], "a string, b bigint").collect() == [("x", None), (None, 2**40)]

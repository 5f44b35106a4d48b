"""Scaling, labels, columns, joins and profile reports on small hand-made tables."""

import warnings
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabloom.functions import expressions as E
from tabloom.operators import columns as C
from tabloom.operators import labels as L
from tabloom.operators import popularity as P
from tabloom.operators import profile as R
from tabloom.operators import scaling as S
from tabloom.operators.joins import join_on_key


def column(df, name):
    return [r[name] for r in df.collect()]


def test_scaling_fixtures(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0)], "id int, a double, b double")
    z = S.ZScore.fit(df, ["a", "b"])
    assert column(z.transform(df).orderBy("id"), "a") == pytest.approx([-0.7071068, 0.7071068])
    assert column(z.transform(df), "b") == [0, 0]
    m = S.MinMax.fit(df, ["a", "b"])
    assert column(m.transform(df).orderBy("id"), "a") == [0, 1]
    assert column(m.transform(df), "b") == [0, 0]
    new = spark.createDataFrame([(3, 5.0, 9.0)], "id int, a double, b double")
    assert z.transform(new).first()["a"] == pytest.approx(2.1213203)
    assert m.transform(new).first()["a"] == 2


def test_impute(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (4, float("nan"))], "id int, x double").withColumn(
        "e", F.lit(None).cast("double")
    )
    filled = S.impute_mean(df, ["x", "e"]).orderBy("id")
    assert column(filled, "x") == [1, 2, 3, 2] and column(filled, "e") == [0, 0, 0, 0]


def test_test_rows_do_not_move_parameters(spark):
    df = spark.range(100).select("id", F.col("id").cast("double").alias("x"), (F.col("id") % 2).alias("y"))
    _, test, scaler = S.prepared_train_test(df, "id", ["x"], "y", 0.2, 1)
    held = {int(r["id"]) for r in test.collect()}
    moved = df.withColumn("x", F.when(F.col("id").isin(held), F.col("x") * 1000).otherwise(F.col("x")))
    assert len(held) == 20 and S.prepared_train_test(moved, "id", ["x"], "y", 0.2, 1)[2] == scaler


def test_prepared_matrix_is_standardised(spark):
    df = spark.range(1000).select("id", F.rand(1).alias("a"), F.randn(2).alias("b"), F.lit("text").alias("t"))
    found = S.prepared_matrix(df, "id", max_rows=500, seed=1)
    from pyspark.ml.stat import Summarizer

    row = found.select(Summarizer.metrics("count", "mean", "std").summary(F.col("features")).alias("s")).first()["s"]
    assert row["count"] == 500
    assert list(row["mean"]) == pytest.approx([0, 0], abs=1e-6) and list(row["std"]) == pytest.approx([1, 1], abs=1e-6)


def test_labels(spark):
    df = spark.range(1, 101).select("id", F.col("id").cast("double").alias("v"))
    assert Counter(column(L.quantile_label(df, "v"), "label")) == {"Low": 33, "Medium": 33, "High": 34}
    assert Counter(column(L.quantile_label(df, "v", 2), "label")) == {"Low": 50, "High": 50}
    with pytest.raises(ValueError):
        L.quantile_label(df, "v", 4)


def test_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    assert L.one_hot(df, "x").columns == ["x", "x_a", "x_b", "x_c"]
    assert column(L.one_hot(df.where("x <> 'c'"), "x", positive="b"), "x_b") == [False, True]
    with pytest.raises(Exception, match="outside"):
        L.one_hot(df, "x", ["a", "b"]).collect()
    with pytest.raises(ValueError):
        L.one_hot(df, "x", ["a"])
    boolean = df.select((F.col("x") == "a").alias("x"))
    assert column(L.one_hot(boolean, "x"), "x_true") == [True, False, False]


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, 3.0, None, "t")], "id int, MFCC_mean double, tempo double, loud double, gone double, txt string"
    )
    assert C.find_column(df, "mfcc") == "MFCC_mean" and C.find_column(df, "nope") is None
    assert C.column_groups(df) == {"mfcc": ["MFCC_mean"], "rhythm": ["tempo"], "other": ["id", "loud"]}
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert C.numeric_features(df, ["id"]).columns == ["MFCC_mean", "tempo", "loud", "gone"]
    assert any("txt" in str(w.message) for w in seen)
    assert C.valid_values(df, "absent", ["id"]).count() == 0


def test_names(spark):
    df = spark.createDataFrame([("mfcc_mean_01",)], "c string")
    row = df.select(E.last_token("c").alias("t"), E.group_title("c").alias("g")).first()
    assert (row["t"], row["g"]) == ("01", "Mfcc Mean 01")


@pytest.mark.parametrize("split", [None, {7: 4}])
def test_join_with_hot_keys(spark, split):
    """A third of the rows share one key on both sides; the result is whole either way."""
    left = spark.range(300).select(F.when(F.col("id") < 100, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(90).select(F.when(F.col("id") < 30, 7).otherwise(F.col("id") + 80).alias("k"), F.col("id").alias("r"))
    right = right.union(spark.createDataFrame([(None, 1)], "k bigint, r bigint"))
    joined = join_on_key(left, right, "k", name="key", split_left=split, split_right=split and {7: 3})
    expected = left.join(right, "k")
    assert joined.count() == expected.count() == 100 * 30 + 60
    assert joined.select(F.sum(F.hash("key", "l", "r"))).first() == expected.select(
        F.sum(F.hash(F.col("k").cast("string"), "l", "r"))
    ).first()
    assert dict(joined.dtypes)["key"] == "string"


def test_join_of_different_key_types(spark):
    left = spark.createDataFrame([("1", "a"), ("x", "b")], "k string, l string")
    right = spark.createDataFrame([(1, 2.0)], "k int, r double")
    assert join_on_key(left, right, "k").collect()[0].asDict() == {"track_id": "1", "l": "a", "r": 2.0}


def test_quality_report(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None)], "a int, b string, c int")
    report = R.quality_report(df)
    assert [tuple(r) for r in report["missing"].collect()] == [("c", 2, 100.0, 2), ("b", 1, 50.0, 2)]
    assert report["size"].first().asDict() == {"n_rows": 2, "n_columns": 3}
    assert report["types"].first()["data_type"] == "int"


def test_yearly_counts_gates(spark):
    texts = ["2008-11-26", "11/27/2009", "26-11-2010", "2008/01/02", "not a date", None]
    df = spark.createDataFrame([(t,) for t in texts * 30], "track_date_created string")
    assert {r[0]: r[1] for r in R.yearly_counts(df, "track_date_created").collect()} == {2008: 60, 2009: 30, 2010: 30}
    assert R.yearly_counts(df.limit(90), "track_date_created").count() == 0
    one_year = df.where("track_date_created = '2008-11-26'").union(df.where("track_date_created = '2008/01/02'"))
    assert R.yearly_counts(one_year.union(one_year), "track_date_created").count() == 0
    assert set(R.temporal_report(df)) == {"columns", "range", "yearly"}


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 0.5, 1, 1, None or 0.25)], "v double")
    rows = {r["bin"]: r["n"] for r in R.histogram(df, "v", 4).collect()}
    assert rows == {0: 1, 1: 1, 2: 1, 3: 2}
    assert R.histogram(df.where("v = 1"), "v", 4).collect()[0]["bin"] == 0
    assert R.histogram(df.where("v > 9"), "v", 4).count() == 0


def test_box_and_categories(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4, 100)] + [("b", 1.0), (None, 5.0)], "g string, v double")
    row = R.box_summary(df.where("g = 'a'"), ["v"], ["g"]).first()
    assert (row["whisker_low"], row["q1"], row["median"], row["q3"], row["whisker_high"], row["n_outliers"]) == (1, 2, 3, 4, 4, 1)
    assert R.feature_by_category(df, "g", ["v"]).count() == 2
    assert R.feature_by_category(df.where("g = 'a'"), "g", ["v"]).count() == 0
    assert R.category_distribution(df, "g").first().asDict() == {"g": "a", "n": 5, "pct": pytest.approx(500 / 6)}


def test_correlation_skips_equal_suffix(spark):
    df = spark.range(50).select(
        F.col("id").cast("double").alias("a_mean"), (F.col("id") * 2.0).alias("b_mean"), (F.col("id") * -1.0).alias("c_std")
    ).withColumn("constant_x", F.lit(1.0))
    pairs = {(r["feature1"], r["feature2"]) for r in R.correlation_pairs(df).collect()}
    assert pairs == {("a_mean", "c_std"), ("b_mean", "c_std")}


@pytest.mark.parametrize("block,products", [(64, 4_000_000), (3, 9)])
def test_correlation_of_many_columns(spark, monkeypatch, block, products):
    import numpy as np

    monkeypatch.setattr(R, "COLUMN_BLOCK", block)
    monkeypatch.setattr(R, "PRODUCTS", products)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(120, 4))
    x = np.column_stack([base, base @ rng.normal(size=(4, 7)) + 0.3 * rng.normal(size=(120, 7)), np.full(120, 0.1)])
    x[rng.random(x.shape) < 0.05] = np.nan
    rows = [[None if np.isnan(v) else float(v) for v in row] for row in x]
    df = spark.createDataFrame(rows, ", ".join(f"c{i}_t{i} double" for i in range(12))).repartition(5)
    filled = np.where(np.isnan(x), np.nanmean(x, axis=0), x)
    r = np.corrcoef(filled[:, :11].T)
    wanted = {(f"c{i}_t{i}", f"c{j}_t{j}"): r[i, j] for i in range(11) for j in range(i + 1, 11) if abs(r[i, j]) > 0.5}
    got = R.correlation_pairs(df, above=0.5, top=None).collect()
    assert {(g["feature1"], g["feature2"]): pytest.approx(g["correlation"]) for g in got} == wanted and len(wanted) > 5
    assert [abs(g["correlation"]) for g in got] == sorted((abs(g["correlation"]) for g in got), reverse=True)
    assert len(R.correlation_pairs(df, above=0.5, top=2).collect()) == 2
    assert R.correlation_pairs(df.select("c0_t0")).collect() == []


def test_popularity_report(spark):
    df = spark.range(400).select(
        F.col("id").alias("track_id"),
        (F.col("id") % 50).cast("double").alias("track_listens"),
        F.when(F.col("id") % 3 == 0, "rock").when(F.col("id") < 10, "rare").alias("track_genre_top"),
        (40 + F.col("id")).cast("double").alias("track_duration"),
        F.lit(None).cast("double").alias("track_favorites"),
    )
    assert P.popularity_metrics(df) == {"listens": "track_listens"}
    report = P.popularity_report(df, "track_id")
    assert [r["track_genre_top"] for r in report["by_category"].collect()] == ["rock"]
    assert report["points"].count() == 392
    assert [r["duration_bin"] for r in report["by_minutes"].collect()] == ["1-2min", "2-3min", "3-4min", "4-5min", "5-6min"]
    assert report["histogram_listens"].agg(F.sum("n")).first()[0] == 400
    assert P.popularity_histogram(df.limit(100), "track_listens").count() == 0
    assert P.duration_popularity_points(df, "track_id", "track_duration", "track_listens", sample=100).count() == 100
    assert P.duration_popularity_points(df.limit(50), "track_id", "track_duration", "track_listens").count() == 0

"""Hand-computed metric vectors, under the usual names."""

import pytest
from pyspark.sql import functions as F

from tabloom.functions.expressions import half_even, score_to_class
from tabloom.operators import metrics as M

WIDE = "y string, p string"


def values(df):
    row = df.first()
    return [row[m] for m in M.METRICS]


def close(got, expected):
    assert got == pytest.approx(expected, abs=1e-6)


def test_boolean(spark):
    p = [0, 0, 1, 1, 0, 1, 1, 0, 0, 0, 1, 1]
    y = [0, 1, 1, 0, 1, 1, 1, 0, 1, 1, 0, 0]
    df = spark.createDataFrame([(bool(a), bool(b)) for a, b in zip(y, p)], "y boolean, p boolean")
    row = M.binary_metrics(df, "y", "p").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 3, 4, 3)
    close([row[m] for m in M.METRICS], [5 / 12, 7 / 12, 3 / 6, 3 / 7, 2 / 6, 2 / 5, 6 / 13])
    assert M.accuracy(df, "y", "p").first()[0] == pytest.approx(5 / 12)


def test_scores(spark):
    rows = [(0.4, False), (0.6, True), (1.0, True), (0.4, True), (0.55, False)]
    df = spark.createDataFrame(rows, "s double, y boolean")
    row = M.binary_metrics_scores(df, "y", "s").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (1, 1, 1, 2)
    close([row[m] for m in M.METRICS], [3 / 5, 2 / 5, 2 / 3, 2 / 3, 1 / 2, 1 / 2, 2 / 3])
    assert M.accuracy_scores(df, "y", ["s"]).first()[0] == pytest.approx(0.6)


THREE = [("2", "2"), ("1", "0"), ("1", "1"), ("0", "2"), ("0", "2")]


def test_three_classes(spark):
    df = spark.createDataFrame(THREE, WIDE)
    counts = M.confusion_counts(df, "y", "p")
    assert M.confusion_matrix(counts, ["0", "1", "2"]).first()["cm"] == [[0, 0, 2], [1, 1, 0], [0, 0, 1]]
    close(values(M.averaged_metrics(counts, weighted=False)), [0.4, 0.6, 0.4444444, 0.5, 0.75, 0.7222222, 0.3888889])
    close(values(M.multiclass_metrics(df, "y", "p")), [0.4, 0.6, 0.4666667, 0.4, 0.7, 0.7666667, 0.3666667])


def test_three_class_scores(spark):
    scores = [(0.0, 0.0, 0.7), (0.0, 0.0, 0.6), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0), (0.0, 0.0, 1.0)]
    rows = [(int(y), *s) for (y, _), s in zip(THREE, scores)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double")
    picked = [r[0] for r in df.select(score_to_class(["a", "b", "c"])).collect()]
    assert picked == [2, 2, 1, 2, 2]
    macro = M.multiclass_metrics_scores(df, "y", ["a", "b", "c"], weighted=False)
    close(values(macro), [0.4, 0.6, 0.4166667, 0.5, 0.5833333, 0.4166667, 0.3555556])
    weighted = M.multiclass_metrics_scores(df, "y", ["a", "b", "c"])
    close(values(weighted), [0.4, 0.6, 0.45, 0.4, 0.5, 0.45, 0.3466667])
    with pytest.raises(ValueError):
        score_to_class(["a", "b"])


@pytest.mark.parametrize("labels", [["dog", "cat", "3", "green", "dog", "3", "dog"], ["dog", "cat"]])
def test_all_correct(spark, labels):
    df = spark.createDataFrame([(v, v) for v in labels], WIDE)
    close(values(M.multiclass_metrics(df, "y", "p")), [1, 0, 1, 1, 1, 1, 1])


def test_edges(spark):
    negatives = spark.createDataFrame([(False, False)] * 3, "y boolean, p boolean")
    close(values(M.binary_metrics(negatives, "y", "p")), [1, 0, 1, 1, 1, 1, 1])
    wrong = spark.createDataFrame([(False, True), (True, False)], "y boolean, p boolean")
    close(values(M.binary_metrics(wrong, "y", "p")), [0, 1, 0, 0, 0, 0, 0])
    empty = M.binary_metrics(wrong.limit(0), "y", "p").first()
    assert (empty["accuracy"], empty["error_rate"]) == (0, 0)


def test_given_classes(spark):
    df = spark.createDataFrame(THREE, WIDE)
    counts = M.confusion_counts(df, "y", "p", classes=["0", "1", "2", "3"])
    assert counts.count() == 16 and counts.agg(F.sum("n")).first()[0] == 5
    with pytest.raises(Exception, match="outside the classes"):
        M.confusion_counts(df, "y", "p", classes=["0", "1"]).collect()


def test_positive_class_equals_binary(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"), ("b", "b")], WIDE)
    positive = values(M.multiclass_metrics(df, "y", "p", positive="a"))
    close(positive, values(M.binary_metrics(df, F.col("y") == "a", F.col("p") == "a")))


def test_weighted_recall_is_accuracy(spark):
    df = spark.range(500).select((F.col("id") % 4).cast("string").alias("y"), (F.col("id") % 7 % 4).cast("string").alias("p"))
    row = M.multiclass_metrics(df, "y", "p").first()
    assert row["recall"] == pytest.approx(row["accuracy"])


def test_half_even():
    assert [half_even(v) for v in (0.5, 1.5, 2.5, 2.51, 30.0)] == [0, 2, 2, 3, 30]


def test_a_missing_prediction_is_wrong(spark):
    df = spark.createDataFrame([("a", "a"), ("b", None), (None, "a"), ("a", "a")], WIDE)
    assert M.accuracy(df, "y", "p").first()[0] == pytest.approx(2 / 3)
    whole = M.multiclass_metrics(df, "y", "p").first()
    assert whole["accuracy"] == pytest.approx(2 / 3) and whole["recall"] == pytest.approx(2 / 3)
    flags = df.select((F.col("y") == "a").alias("y"), (F.col("p") == "a").alias("p"))
    row = M.binary_metrics(flags, "y", "p").first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (2, 1, 0, 0)
    positive = M.multiclass_metrics(df, "y", "p", positive="a").first()
    assert positive["accuracy"] == pytest.approx(2 / 3)
    hot = spark.createDataFrame([(True, False, True, None), (True, False, True, False)], "a boolean, b boolean, c boolean, d boolean")
    assert M.accuracy_one_hot(hot, ["a", "b"], ["c", "d"]).first()[0] == 0.5


def test_an_unseen_label_is_counted_and_never_predicted(spark):
    from tabloom.plans.evaluation import UNSEEN, collected_counts

    df = spark.createDataFrame([(0.0, 0.0), (None, 0.0), (1.0, 1.0)], "y double, prediction double")
    assert sorted(collected_counts(df, "y", ["a", "b"])) == [(UNSEEN, "a", 1), ("a", "a", 1), ("b", "b", 1)]

"""Plans that must hold at scale: no pair-wise joins, pruned scans, one scan where one is enough."""

import importlib
import re

import compare
import pytest
from pyspark.sql import functions as F

from tabloom.operators import profile as R
from tabloom.operators.joins import join_on_key
from tabloom.operators.splits import holdout, kfold

FOLDER = "/root/testdata/sf0.001"
entry = importlib.import_module("__spark_entry__")


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"== Initial Plan ==.*?(?=== Final|\Z)", "", text, flags=re.S)


@pytest.mark.parametrize("name", sorted(set(entry.plain_queries()) - set(entry.oracle_sql())))
def test_no_pairwise_join(spark, name):
    """The queries without SQL; the others are checked where they are compared."""
    compare.check_plan(name, entry.plain_queries()[name](spark, FOLDER))


def test_splits_do_not_shuffle_rows(spark):
    df = spark.read.parquet(f"{FOLDER}/events.parquet")
    for marked in (holdout(df, "event_id", 0.2), kfold(df, "event_id", 5, strata=["event_type"])):
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Sort" not in plan


def test_join_reads_only_wanted_columns(spark):
    lines, part = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("lineitem", "part"))
    joined = join_on_key(lines, part, "l_partkey", "p_partkey", "k", ["l_quantity"], ["p_size"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan


@pytest.mark.parametrize("report", ["category", "years"])
def test_reports_scan_once(spark, report):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    if report == "category":
        df = R.category_distribution(orders, "o_orderpriority")
    else:
        df = R.yearly_counts(orders, "o_orderdate")
    assert "ReusedExchange" in final_plan(df)


def test_profile_uses_one_scan(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumn("gap", F.lit(None).cast("int"))
    assert final_plan(R.missing_report(orders)).count("FileScan") == 1


def test_results_do_not_depend_on_partitions(spark):
    names = ["multiclass_metrics_weighted", "kfold", "box_by_category", "knn_predict"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append([sorted(map(str, entry.queries()[n](spark, FOLDER).collect())) for n in names])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["recall"] == pytest.approx(row["accuracy"])

"""The numbered queries and the pipeline."""

import collections
import importlib

import pytest
from pyspark.sql import functions as F

from tabloom.llm.catalog import QUERIES
from tabloom.llm.common import table

FOLDER = "/root/testdata/sf0.001"
NATIVE = ("op1_pii", "op2_licenses", "op3_sharding", "op6_decontamination", "op8_secrets")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    seen = [docs.count()]
    for name, stage in pipeline.STAGES:
        before = collections.Counter(r.doc_id for r in docs.collect())
        docs = stage(spark, docs, FOLDER)
        rows = docs.collect()
        seen.append(len(rows))
        if name != "sharding":
            assert docs.columns == columns
        assert {r.doc_id for r in rows} <= set(before)
        if name in ("quality", "near_dedup", "decontamination"):
            assert collections.Counter(r.doc_id for r in rows) <= before
    assert seen[1] < seen[0] and seen[2] < seen[1] and seen[5] == seen[4]
    assert set(columns) < set(docs.columns) and docs.where(F.col("shard").isNull()).count() == 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n for n, _ in importlib.import_module("corpus_pipeline").STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]

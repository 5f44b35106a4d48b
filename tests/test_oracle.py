"""Every query with SQL gives the same rows as the SQL on the smallest tables."""

import importlib

import compare
import pytest

FOLDER = "/root/testdata/sf0.001"
entry = importlib.import_module("__spark_entry__")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    compare.check_plan(name, df)
    assert compare.difference(df, con, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

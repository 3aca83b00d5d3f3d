"""Every registered query against its oracle, row for row, and its plan for
Python workers and pairwise joins."""

import pytest

import __spark_entry__ as spark_entry
from conftest import SF_DIR
from registry.core import ORACLES, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted((repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect()))
    relation = duck.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    quoted = [f'"{c}"' for c in columns]
    assert ours == sorted(map(repr, relation.select(*quoted).fetchall()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "CollectLimit"):
        assert word not in plan


def test_entry_returns_rows(spark):
    df = spark_entry.entry(spark)
    assert df.columns
    assert df.count() >= 0

"""The registered queries against their SQL, and which of them keep to the JVM."""

import re

import pytest

import __spark_entry__ as entry
from parity import connect, differences
from wickwork.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
NATIVE = ["op1_sharding", "op4_quality_rules", "op12_url_filters"]


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_entry_has_the_operators_and_the_pipeline():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert SQL.items() <= entry.oracle_sql().items()


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    if name in NATIVE:
        assert not re.findall(r"Python|Pandas|Arrow", plan)
    message, count = differences(spark, db, FOLDER, lambda *_: df, SQL[name])
    assert message is None, message
    assert count > 0

"""Every registered query against its SQL, on the smallest driver tables."""

import re
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from parity import connect, differences
from wickwork.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
# Answers that are the same few rows whatever the input is, and those that may be empty here.
MAY_BE_EMPTY = {"pk_dupes", "lag_alert", "stream_lag_alert", "prune_days", "prune_months", "prune_table"}


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_the_catalog():
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("missing", ["corpus_pipeline", "wickwork.llm", "public_tokenizers", "tiktoken", "tokenizers", "ahocorasick", "xxhash"])
def test_entry_without_the_training_data_operators(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rpartition("/")[0])
    assert done.stdout.split() == [str(len(QUERIES)), str(len(SQL))], done.stderr
    assert "left out" in done.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"CartesianProduct|BroadcastNestedLoopJoin|EvalPython|MapInPandas|InPandas", plan)
    message, count = differences(spark, db, FOLDER, lambda *_: df, SQL[name])
    assert message is None, message
    assert count > 0 or name in MAY_BE_EMPTY


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "candle_count" in df.columns

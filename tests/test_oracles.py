"""Every registered query against its oracle on the smallest tables, and the shape of its plan."""

import re

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare
from ledgerloom.sources.standins import RAW_TABLES

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, small, name):
    text, _ = compare(spark, con, small, name, QUERIES[name], ORACLES[name])
    assert text.startswith("ok"), text


def test_every_query_has_an_oracle():
    """Those for training data have tests of their own where SQL cannot express them."""
    assert set(ORACLES) <= set(QUERIES)
    assert not [n for n in set(QUERIES) - set(ORACLES) if n != "pipeline" and not re.match(r"op\d+_", n)]


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not re.match(r"list_|op\d+_|pipeline", n)])
def test_plan_shape(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert "Exchange SinglePartition" not in plan

"""Every query against its SQL on an independent engine, and the shape of their plans."""

import os
import re

import pytest

from __spark_entry__ import entry
from pairwright.workload.oracle import ORACLE
from pairwright.workload.queries import QUERIES
from tests.comparing import difference, duck

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, FOLDER)
    assert difference(result, connection, ORACLE[name]) is None
    if name == "als_topn":  # products of factor blocks, fitted and stored before the plan that is returned
        return
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", plan)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert entry(spark).count() == 183


def test_scans_read_only_what_is_needed(spark):
    plan = QUERIES["topn_dense_rank"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan and "event_type" not in plan
    assert "WindowGroupLimit" in plan

"""Every registered query against its SQL twin."""

import os

import pytest
from compare import connect, difference
from conftest import executed_plans, plan_of

from statflow.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("STATFLOW_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


# queries that gather one row per range partition
GATHERS_BOUNDS = ("q3_", "n3_growth")


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    before = max(executed_plans(spark), default=-1)
    df = QUERIES[name](spark, FOLDER)
    plan = plan_of(df)
    ran = executed_plans(spark, before)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "InPandas"):
        assert not [key for key, text in {**ran, "returned": plan}.items() if node in text], node
    assert "SinglePartition" not in plan or name.startswith(GATHERS_BOUNDS)
    # also in what a query wrote on its way: Python only where a client is asked
    everywhere = any("MapInArrow" in text for text in [plan, *ran.values()])
    assert everywhere == name.startswith(("u1_", "flow3_collect_chunks"))
    assert difference(df, con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    counts = [row.subscriber_count for row in rows]
    assert counts == sorted(counts, reverse=True)

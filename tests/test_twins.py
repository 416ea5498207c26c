"""Every registered query against its DuckDB twin on the smallest test tables."""

import os

import pytest

from cohortlens.checks.compare import connect, differences
from cohortlens.checks.oracle import oracle
from cohortlens.checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TWINS = oracle()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_twin_belongs_to_a_query():
    assert set(TWINS) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(TWINS))
def test_same_result(spark, con, key):
    df = QUERIES[key](spark, FOLDER)
    found = differences(df, con, TWINS[key])
    assert [f for f in found if f != "no rows at all"] == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert unwanted not in plan


# Sort keys of the queries whose row order is part of the result.
ORDERS = {
    "sort_customer": lambda r: r["customer_id"],
    "topk_states": lambda r: (-r["default_rate"], r["state"]),
    "sort_state_counts": lambda r: (r["n"], r["state"]),
    "sort_profiles": lambda r: (-r["observed_proportion"], -r["odds_ratio"]),
    "agg_value_counts": lambda r: (r["column_name"], -r["n"], r["value"] is not None, r["value"] or ""),
    "sink_readback": lambda r: (-r["customer_count"], r["segment_assigned"]),
}


@pytest.mark.parametrize("key", sorted(ORDERS))
def test_rows_come_in_order(spark, key):
    rows = QUERIES[key](spark, FOLDER).collect()
    assert rows and rows == sorted(rows, key=ORDERS[key])


def test_elbow(spark):
    rows = sorted(QUERIES["ml_elbow_k"](spark, FOLDER).collect())
    assert [r["k"] for r in rows] == [1, 2, 3, 4]
    assert all(a["inertia"] >= b["inertia"] for a, b in zip(rows, rows[1:]))
    assert 2 <= rows[0]["optimal_k"] <= 4

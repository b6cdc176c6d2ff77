"""Every registered query against its SQL, and the properties of plans that matter at scale."""

import re
from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, differences
from tests.conftest import TESTDATA
from tickloom.plans.queries import ORACLES, QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    rows, found = differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not found
    assert rows > 0


def test_all_are_registered():
    assert QUERIES.items() <= queries().items() and ORACLES.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).columns == ["timestamp", "total", "known"]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_no_python(spark):
    for name in QUERIES:
        if not name.startswith("stream_") and name not in ("topic_route", "csv_round_trip"):
            plan = plan_of(QUERIES[name](spark, SF_DIR))
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
            assert "Python" not in plan and "InPandas" not in plan, name


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["latest_prices"](spark, SF_DIR))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan)
    assert "props" not in plan.split("FileScan")[1].split("Batched")[0]
    assert schema is None or "props" not in schema.group(1)
    plan = plan_of(QUERIES["company_symbols"](spark, SF_DIR))
    assert "EqualTo(event_type,signup)" in plan


def test_aggregates_are_partial_before_the_shuffle(spark):
    for name in ("latest_prices", "window_stats_1h", "summary_1h", "distinct_symbols"):
        below = plan_of(QUERIES[name](spark, SF_DIR)).split("Exchange", 1)[1]
        assert "partial_" in below or "keys=[symbol" in below, name


def test_completed_total_scans_once(spark):
    """Four uses of the trades in the text of the plan, one scan and one shuffle of them at run time."""
    df = QUERIES["completed_total_user"](spark, SF_DIR)
    df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2
    assert final.count("FileScan") == 1


def test_no_forbidden_names():
    root = Path(__file__).parent.parent
    text = "".join(p.read_text() for p in root.glob("tickloom/**/*.py"))
    assert "localCheckpoint" not in text and ".rdd" not in text and "crossJoin" not in text

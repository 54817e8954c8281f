"""Every registered query against its SQL twin."""

from __future__ import annotations

import duckdb
import pytest
from conftest import executed_plan

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(columns, rows):
    """Rows with columns in name order, sorted."""
    places = [columns.index(name) for name in sorted(columns)]
    return sorted(repr([row[place] for place in places]) for row in rows)


def test_every_query_has_sql():
    assert set(contract._own_sql()) == set(contract._own_queries())


@pytest.mark.parametrize("name", sorted(contract._own_queries()))
def test_query_equals_sql(name, spark, duck):
    result = contract.queries()[name](spark, SF_DIR)
    answer = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in answer.description]
    assert sorted(result.columns) == sorted(columns)
    expected = ordered(columns, answer.fetchall())
    assert ordered(result.columns, result.collect()) == expected
    assert expected


LOADS = set("""readings_master mixed_readings_master streamed_readings bookings_master streamed_bookings meta_master
    traces_master text_masters edge_report wifi_views signal_report traffic_views""".split())


@pytest.mark.parametrize("name", sorted(set(contract._own_queries()) - LOADS))
def test_plans_at_scale(name, spark, conf):
    """What is planned for inputs too large to broadcast, before adaptive execution."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = executed_plan(contract.queries()[name](spark, SF_DIR))
    for unwanted in ("NestedLoop", "Cartesian", "EvalPython", "InPandas", "Window", "BroadcastExchange"):
        assert unwanted not in plan
    # One count per task is all that meets in a single place, and only for the global count.
    assert plan.count("SinglePartition") == (1 if name == "timestep_count" else 0)


def test_entry(spark):
    assert contract.entry(spark).count() > 0

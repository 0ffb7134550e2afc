"""Registered queries: equal rows on both engines, and plans fit for large tables."""

import re

import pytest

from checks.compare import connect, duck_rows, spark_rows
from checks.oracle import oracle_sql
from checks.queries import queries

DIRECTORY = "/root/testdata/sf0.001"
NAMES = sorted(queries())


@pytest.fixture(scope="module")
def duck():
    return connect(DIRECTORY)


def test_every_query_has_check_sql():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_on_both_engines(spark, duck, name):
    names, got = spark_rows(queries()[name](spark, DIRECTORY))
    expected_names, expected = duck_rows(duck, oracle_sql()[name])
    assert names == expected_names
    assert got == expected


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    """As for tables of which no side is small enough to broadcast."""
    monkeypatch.setattr("checks.queries.fits_broadcast", lambda df: False)
    monkeypatch.setattr("checks.queries.broadcast_if_small", lambda df: df)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


# Queries that take another way when a measured side is small.
MEASURED = ["best_mrn", "cdm_person", "cdm_visit", "pii_name", "register_identifiers", "review_queue",
            "second_match_members"]


@pytest.mark.parametrize("name", MEASURED)
def test_same_rows_without_any_broadcast(spark, duck, no_broadcast, name):
    _, got = spark_rows(queries()[name](spark, DIRECTORY))
    _, expected = duck_rows(duck, oracle_sql()[name])
    assert got == expected


@pytest.mark.parametrize("name, table", [("cdm_visit", "o_custkey"), ("pii_phone", "c_custkey")])
def test_small_side_is_broadcast_and_the_large_table_not_shuffled(spark, name, table):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = queries()[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, old)
    head = plan[: plan.index("BroadcastExchange")]
    assert "BroadcastHashJoin" in head and "SortMergeJoin" not in head


# Places in files need the rows of the files before, a few numbers that are sent to all tasks.
POSITIONS = {"review_queue_order", "review_report_order"}


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_only_equi_joins_and_no_python(spark, no_broadcast, name):
    plan = queries()[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    sent = "" if name in POSITIONS else "|BroadcastHashJoin"
    assert not re.search(rf"CartesianProduct|NestedLoop|Python{sent}", plan)


def test_bucketed_tables_join_in_place(spark, no_broadcast):
    for name in ("crosswalk_bucketed", "contacts_bucketed"):
        plan = queries()[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_reconcile_reads_each_roster_once(spark, no_broadcast):
    """Each roster is read for its keys, and the master once more for its links."""
    plan = queries()["reconcile"](spark, DIRECTORY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [study_key") == 1 and plan.count("Generate explode") <= 2


def test_visit_scan_reads_only_what_it_needs(spark, no_broadcast):
    plan = queries()["pii_email"](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "c_mktsegment" not in plan

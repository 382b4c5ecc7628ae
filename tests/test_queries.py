"""Every registered query against its SQL statement, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as registry
from check import differences, duck
from vigil import oracle
from vigil.plans import registered

FOLDER = "/root/testdata/sf0.01"
SQL = oracle.statements()
QUERIES = registered.QUERIES


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_a_statement():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == []


def test_entry(spark):
    rows = registry.entry(spark)
    assert rows.columns[0] == "transaction_date" and rows.count() > 0


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


NOT_STREAMS = sorted(n for n in QUERIES if not n.endswith("_stream"))


@pytest.mark.parametrize("name", NOT_STREAMS)
def test_no_pairs_and_no_python_in_plans(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", NOT_STREAMS)
def test_no_window_over_one_partition(spark, name):
    assert not re.search(r"Window [^\n]*\n(?:[^\n]*Sort[^\n]*\n)?[^\n]*Exchange SinglePartition", plan(spark, name))


def test_plan_shapes(spark):
    assert plan(spark, "daily_fraud_summary").count("WindowGroupLimit") == 2
    assert "LeftSemi" in plan(spark, "orders_with_recent_events")
    assert "TakeOrderedAndProject" in plan(spark, "customer_revenue_top")
    assert "StringContains(" in plan(spark, "email_search") or "Contains(" in plan(spark, "email_search")
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, "event_counts_recent")).group(1)
    assert set(re.findall(r"(\w+):", scan)) == {"ts", "user_id", "event_type"}
    assert "GreaterThanOrEqual(ts" in plan(spark, "event_counts_recent")


def exchanges(spark, name):
    """Shuffles of a plan without broadcasts, reused ones counted once."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = QUERIES[name](spark, FOLDER)
        frame.collect()  # then the plan is the one that ran, in which equal shuffles are reused
        text = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = text.split("Initial Plan")[0]
    return len(re.findall(r"- Exchange hashpartitioning", final))


@pytest.mark.parametrize(
    "name, most", [("transaction_risk_score", 10), ("cumulative_spend", 9), ("daily_fraud_summary", 13), ("balances_after_approval", 4)]
)
def test_number_of_shuffles(spark, name, most):
    assert exchanges(spark, name) <= most

"""Keyed operators, running totals, ranks, audit rows, quality checks."""

import json
import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions import columns
from vigil.operators import audit, keyed, quality
from vigil.operators.ranking import rank_by_value
from vigil.operators.running import running_totals

AS_OF = "2026-06-02 00:00:00"


def bag(rows):
    return sorted(map(tuple, rows.collect()), key=str)


# Expressions.


def test_card_mask(frame):
    rows = frame([(None,), ("",), ("123",), ("1234",), ("4111111111111234",)], "n string")
    masked = [r[0] for r in rows.select(columns.mask_card(F.col("n"))).collect()]
    assert masked == ["****", "****", "****", "****-****-****-1234", "****-****-****-1234"]


def test_risk_country_keeps_null(frame):
    rows = frame([("UA",), ("KP",), ("DE",), ("IR",), (None,)], "c string")
    flags = [r[0] for r in rows.select(columns.is_risk_country(F.col("c"))).collect()]
    assert flags == [False, True, False, True, None]


def test_age_of_leap_day_births(frame):
    leap = date(2000, 2, 29)
    cases = [(leap, date(2001, 2, 28), 0), (leap, date(2001, 3, 1), 1), (leap, date(2004, 2, 29), 4),
             (date(1990, 6, 2), date(2026, 6, 2), 36), (date(1990, 6, 3), date(2026, 6, 2), 35)]
    rows = frame(cases, "born date, today date, want int")
    ages = rows.select("want", columns.age_in_years(F.col("born"), F.col("today")).alias("age")).collect()
    assert [r.age for r in ages] == [r.want for r in ages]


def test_mean_rounds_halves_up_and_labels_the_unrounded_mean(frame):
    rows = frame([(201, 200), (0, 0), (5999, 100), (11999, 200), (3000, 100), (29995, 1000)], "s bigint, n bigint")
    found = rows.select(
        columns.mean_2dp(F.col("s"), F.col("n")).cast("string"), columns.mean_risk_label(F.col("s"), F.col("n"))
    ).collect()
    assert [tuple(r) for r in found] == [
        ("1.01", "LOW"), ("0.00", "LOW"), ("59.99", "MEDIUM"), ("60.00", "MEDIUM"), ("30.00", "MEDIUM"),
        ("30.00", "LOW"),
    ]


def test_name_is_null_when_a_part_is(frame):
    rows = frame([("A", "B"), (None, "B")], "f string, l string")
    assert [r[0] for r in rows.select(columns.full_name(F.col("f"), F.col("l"))).collect()] == ["A B", None]


# Keyed operators.


def test_defaults_fill_absent_columns_only(frame):
    rows = keyed.with_defaults(frame([(1, None)], "id int, status string"), {"status": "PENDING", "score": 0})
    assert bag(rows) == [(1, None, 0)]


def test_insert_absent_takes_one_row_per_new_key(frame):
    target = frame([(1, "old"), (2, None)], "id int, v string")
    batch = frame([(1, "new"), (3, "b"), (3, "a"), (3, "a"), (4, None)], "id int, v string")
    assert bag(keyed.insert_absent(batch, target, "id")) == [(3, "a"), (4, None)]
    assert bag(keyed.insert_absent(batch, target.unionByName(batch), "id")) == []


def test_update_sets_given_columns_even_to_null(frame):
    table = frame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "id int, v string, w string")
    updates = frame([(1, None), (3, "C"), (9, "no")], "id int, v string")
    assert bag(keyed.update_columns(table, updates, "id")) == [(1, None, "x"), (2, "b", "y"), (3, "C", "z")]


def test_references_are_removed_or_cleared(frame):
    child = frame([(1, 10), (2, 20), (3, None), (4, 10)], "id int, ref int")
    gone = frame([(10,), (10,), (30,)], "key int")
    assert bag(keyed.without_references(child, "ref", gone).select("id", "ref")) == [(2, 20), (3, None)]
    assert bag(keyed.clear_references(child, "ref", gone)) == [(1, None), (2, 20), (3, None), (4, None)]


def test_split_and_join_give_the_wide_rows_back(frame):
    wide = frame([(1, "a", "b", None), (2, None, "d", "e")], "id int, x string, y string, z string")
    parts = keyed.split_columns(wide, [["id", "x"], ["id", "y"], ["id", "z"]])
    assert bag(keyed.join_parts(parts, "id")) == bag(wide)


# Running totals and ranks.


def test_running_totals_equal_the_plain_window(frame):
    pick = random.Random(5)
    start = datetime(2026, 1, 1)
    rows = [
        (pick.choice([i, i + 3 * 10**6]), pick.choice([1, 1, 2, 3, 9]), Decimal(pick.randrange(1, 9999)) / 100,
         start + timedelta(seconds=pick.choice([0, 30, 59, 60, 61, pick.randrange(10**5)])))
        for i in range(300)
    ]
    moves = frame(rows, "transaction_id bigint, account_id bigint, amount decimal(15,2), transaction_at timestamp_ntz")
    accounts = frame([(1, 10), (2, 10), (3, 20)], "account_id bigint, customer_id bigint")
    picked = ["transaction_id", "customer_id", "tx_number", "cumulative_spent"]
    found = bag(running_totals(moves, accounts).select(*picked))
    owner, truth = {1: 10, 2: 10, 3: 20}, []
    for customer in (10, 20):
        total = Decimal(0)
        mine = sorted((r for r in rows if owner.get(r[1]) == customer), key=lambda r: (r[3], r[0]))
        for number, row in enumerate(mine, 1):
            total += row[2]
            truth.append((row[0], customer, number, total))
    assert found == sorted(truth, key=str)


@pytest.mark.parametrize("dense", [False, True])
def test_value_histogram_ranks_equal_window_ranks(frame, dense):
    pick = random.Random(6)
    rows = frame([(i, pick.choice([None, 0, 0, 0, 5, 7, pick.randrange(50)])) for i in range(200)], "id int, v int")
    order = Window.orderBy(F.col("v").desc_nulls_first())
    rank = (F.dense_rank() if dense else F.rank()).over(order).cast("bigint")
    assert bag(rank_by_value(rows, "v", "r", dense)) == bag(rows.withColumn("r", rank))


# Audit rows.


def test_audit_rows(frame):
    kind = "account_id bigint, customer_id bigint, status string, note string, open boolean"
    before = frame([(1, 10, "ACTIVE", "n", True), (2, 20, "ACTIVE", None, True), (3, 30, "ACTIVE", "x", True),
                    (4, 40, "ACTIVE", "q", None)], kind)
    after = frame([(1, 10, "FROZEN", "n", True), (2, 20, "ACTIVE", None, True), (4, 40, "ACTIVE", None, False),
                   (5, 50, "ACTIVE", 'say "hi"', False)], kind)
    rows = audit.audit_changes(
        before, after, "account_id", ["status", "note", "open"], "accounts", "customer_id", AS_OF
    )
    found = {
        r.row_key: (r.operation, r.customer_id, r.old_value and json.loads(r.old_value),
                    r.new_value and json.loads(r.new_value))
        for r in rows.collect()
    }
    assert found == {
        1: ("UPDATE", 10, {"status": "ACTIVE"}, {"status": "FROZEN"}),
        3: ("DELETE", 30, {"status": "ACTIVE", "note": "x", "open": True}, None),
        4: ("UPDATE", 40, {"note": "q", "open": None}, {"note": None, "open": False}),
        5: ("INSERT", 50, None, {"status": "ACTIVE", "note": 'say "hi"', "open": False}),
    }
    parsed = audit.parse_values(rows).filter("row_key = 1").select(
        F.variant_get("new_value", "$.status", "string")
    )
    assert parsed.collect()[0][0] == "FROZEN"


# Data quality.


def _customers(frame, rows):
    return frame(
        [(i, "F", "L", email, born, "UA", None, True) for i, (email, born) in enumerate(rows)], schemas.CUSTOMERS
    )


def test_checks(frame):
    fine, past = "a.b+c@x-y.example", date(1990, 1, 1)
    rows = _customers(frame, [
        (fine, past), (fine.upper(), past), (fine + "\n", past), ("no-at.example", past), ("a@b.c", past),
        (fine, date(2026, 6, 2)), (None, None), ("x" * 250 + "@abc.example", past),
    ])
    found = quality.check_violations({"customers": rows}, quality.payment_rules(AS_OF))
    assert {tuple(r) for r in found.collect()} == {
        ("customers", "email_format", "2"), ("customers", "email_format", "3"), ("customers", "email_format", "4"),
        ("customers", "birth_date_past", "5"), ("customers", "email_required", "6"),
        ("customers", "birth_date_required", "6"), ("customers", "email_length", "7"),
    }


def test_absent_values_hold_in_checks(frame):
    rows = frame([(1, None, "XXX", Decimal("-0.01"), None)], "account_id bigint, customer_id bigint, currency string, balance decimal(15,2), status string")
    found = quality.check_violations({"accounts": rows}, quality.payment_rules(AS_OF))
    assert {r.constraint_name for r in found.collect()} == {
        "customer_id_required", "account_currency", "balance_not_negative", "status_required",
        "account_number_missing", "opened_at_missing",
    }


def test_unique_keys_pass_over_nulls(frame):
    rows = frame([(1, "a"), (2, "a"), (3, None), (4, None), (4, "b")], "customer_id bigint, email string")
    found = quality.unique_violations({"customers": rows}, quality.payment_rules(AS_OF))
    assert {tuple(r) for r in found.collect()} == {
        ("customers", "customers_email", "a", 2), ("customers", "customers_key", "4", 2),
    }


def test_references_pass_over_nulls(frame):
    tables = {
        "transactions": frame([(1, 1, None), (2, 9, 5), (3, 1, 6)], "transaction_id bigint, account_id bigint, card_id bigint"),
        "accounts": frame([(1, 7)], "account_id bigint, customer_id bigint"),
        "cards": frame([(5, 1)], "card_id bigint, account_id bigint"),
    }
    keys = {n: r.key for n, r in quality.payment_rules(AS_OF).items()}
    found = quality.reference_violations(tables, quality.PAYMENT_REFERENCES, keys)
    assert {tuple(r) for r in found.collect()} == {
        ("transactions", "transactions_account", "2", "9"), ("transactions", "transactions_card", "3", "6"),
    }


def test_references_are_held_whole_by_no_task(spark):
    """Neither the parents nor the references seen are collected in one task, however small the files look."""
    tables = {
        "status_history": spark.range(40).selectExpr("id % 25 AS transaction_id"),
        "transactions": spark.range(20).selectExpr("id AS transaction_id"),
    }
    keys = {n: r.key for n, r in quality.payment_rules(AS_OF).items()}
    found = quality.reference_violations(tables, quality.PAYMENT_REFERENCES, keys)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "HashAggregate" not in plan
    assert sorted(r.missing_key for r in found.collect()) == ["20", "21", "22", "23", "24"]


# Substring search.

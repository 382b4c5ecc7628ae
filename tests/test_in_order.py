"""Requests served in order, against a loop over them."""

import random
from decimal import Decimal

import pytest

import sample
from vigil import schemas
from vigil.operators import in_order
from vigil.plans import bank as jobs

REQUESTS = "account_id bigint, place bigint, units bigint, note string"
BALANCES = "account_id bigint, held bigint"


def served(requests, balances):
    left, found = dict(balances), []
    for account, place, units, note in sorted(requests, key=lambda r: r[1]):
        held = left.get(account)
        fits = held is None or units is None or units <= 0 or units <= held
        if fits and held is not None and units is not None and units > 0:
            left[account] -= units
        found.append((account, place, units, note, fits))
    return sorted(found, key=str)


def answers(spark, requests, balances):
    rows = in_order.served_in_order(spark.createDataFrame(requests, REQUESTS).repartition(3), spark.createDataFrame(balances, BALANCES))
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("block", [1, 7, 4_096])
def test_equals_a_loop(spark, monkeypatch, block):
    monkeypatch.setattr(in_order, "BLOCK", block)
    rng = random.Random(block)
    balances = [(a, rng.choice([0, 1, 2, 99, 1_000, 123_456])) for a in range(12)] + [(12, None)]
    sizes = [1, 2, 3, 50, 51, 400, 999, 1_000, 70_000, 0, -5, None]
    # A third of all requests are on account 3.
    requests = [(3 if n % 3 == 0 else rng.randrange(14), place, rng.choice(sizes), f"r{n}") for n, place in enumerate(rng.sample(range(5_000), 400))]
    balances[3] = (3, 65_536)
    assert answers(spark, requests, balances) == served(requests, balances)


def test_a_large_request_is_passed_over_and_a_later_small_one_accepted(spark):
    requests = [(1, 1, 60, "a"), (1, 2, 50, "b"), (1, 3, 40, "c"), (1, 4, 1, "d"), (2, 5, 100, "e"), (2, 6, 1, "f")]
    found = {note: fits for *_, note, fits in answers(spark, requests, [(1, 100), (2, 100)])}
    assert found == {"a": True, "b": False, "c": True, "d": False, "e": True, "f": False}


def test_large_numbers_and_many_halvings(spark):
    held = 10**15 - 1
    requests = [(1, n, 10**15 >> n, "x") for n in range(1, 52)] + [(1, 100 + n, 9 * 10**14, "y") for n in range(20)]
    assert answers(spark, requests, [(1, held)]) == served(requests, [(1, held)])


def test_no_requests_and_no_accounts(spark):
    assert answers(spark, [], [(1, 5)]) == []
    assert answers(spark, [(1, 1, 5, "a")], []) == [(1, 1, 5, "a", True)]
    assert answers(spark, [(1, 1, 5, "a"), (1, 2, 0, "b")], [(1, 0)]) == [(1, 1, 5, "a", False), (1, 2, 0, "b", True)]


def test_process_in_order(spark):
    def table(kind):
        return spark.createDataFrame([], kind)

    empty = jobs.Bank(
        sample.customers(spark), sample.accounts(spark), table(schemas.CARDS), table(schemas.TRANSACTIONS),
        table(schemas.STATUS_HISTORY), sample.rules(spark), table(schemas.FRAUD_ALERTS), table(schemas.AUDIT_LOG),
    )
    at = sample.transactions(spark).first().transaction_at
    waiting = [(i, 9, None, Decimal(a), "EUR", None, None, "PENDING", 0, at) for i, a in ((1, "600.00"), (2, "100.00"), (3, "70.20"), (4, "0.01"))]
    flagged = (5, 10, None, Decimal("20000.00"), "EUR", "GAMBLING", "KP", "PENDING", 0, at)
    bank = empty._replace(transactions=spark.createDataFrame([*waiting, flagged], schemas.TRANSACTIONS))
    requests = spark.createDataFrame([(10, 1), (20, 2), (30, 3), (40, 4), (50, 2), (60, 1), (70, 5), (80, 5), (90, 99), (95, None)], "request_no bigint, transaction_id bigint")
    done = jobs.process_in_order(bank, requests, sample.AS_OF)
    found = {r.request_no: r.reason for r in done.outcomes.collect()}
    assert found == {
        10: None, 20: "overdraft", 30: None, 40: "overdraft", 50: "overdraft", 60: "already processed: APPROVED",
        70: None, 80: "already processed: FLAGGED", 90: "not found", 95: "not found",
    }
    statuses = {r.transaction_id: r.status for r in done.bank.transactions.collect()}
    assert statuses == {1: "APPROVED", 2: "PENDING", 3: "APPROVED", 4: "PENDING", 5: "FLAGGED"}
    assert {r.account_id: str(r.balance) for r in done.bank.accounts.collect()}[9] == "0.00"
    assert [r.transaction_id for r in done.bank.alerts.collect()] == [5]
    assert sorted(r.transaction_id for r in done.bank.history.collect()) == [1, 3, 5]

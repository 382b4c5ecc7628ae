"""Known results for the sample bank, loaded as one batch of arrivals."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sample
from vigil.plans import decisions, reports, summary
from vigil.streaming import ingest


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Store folder after the arrival of all twelve transactions."""
    store = str(tmp_path_factory.mktemp("store"))
    ingest.score_batch(sample.transactions(spark), 0, sample.accounts(spark), store, sample.AS_OF)
    return store


@pytest.fixture(scope="module")
def scored(spark, loaded):
    return ingest.read_output(spark, loaded, "transactions")


def test_scores_and_statuses(scored):
    rows = {r.transaction_id: (r.risk_score, r.status) for r in scored.collect()}
    assert [rows[i][0] for i in range(1, 13)] == [0, 0, 5, 0, 0, 5, 0, 10, 0, 45, 0, 0]
    assert {i for i in rows if rows[i][1] == "PENDING"} == {10}
    assert {rows[i][1] for i in rows if i != 10} == {"APPROVED"}


def test_history_has_two_rows_per_approval_and_one_for_the_rest(spark, loaded):
    history = ingest.read_output(spark, loaded, "history")
    assert history.count() == 23
    assert history.filter("changed_by = 'SYSTEM_AUTO' and old_status is null").count() == 12
    assert ingest.read_output(spark, loaded, "alerts").count() == 0


def test_balances_follow_the_ledger(spark, loaded):
    deltas = ingest.read_output(spark, loaded, "balance_deltas")
    rows = ingest.ledger_balances(sample.accounts(spark), deltas).collect()
    assert {r.account_id: str(r.balance) for r in rows} == {
        1: "14450.50", 2: "380.00", 3: "50.00", 4: "1485.25", 5: "0.00", 6: "11490.00",
        7: "4900.00", 8: "8855.00", 9: "670.20", 10: "33973.00",
    }
    assert not any(r.overdrawn for r in rows)


def test_status_summary(scored):
    rows = {r["status"]: (r["count"], str(r["avg_risk"])) for r in reports.status_summary(scored).collect()}
    assert rows == {"APPROVED": (11, "1.82"), "PENDING": (1, "45.00")}


def test_daily_summary(spark, scored):
    rows = summary.daily_fraud_summary(
        scored, sample.alerts(spark), sample.accounts(spark), sample.customers(spark), sample.AS_OF
    ).collect()
    found = {
        r.transaction_date: (
            r.total_transactions, str(r.total_amount), r.flagged_transactions, str(r.suspicious_amount),
            str(r.avg_risk_score), r.top_risky_customers, r.total_fraud_alerts,
        )
        for r in rows
    }
    assert found == {
        date(2026, 6, 1): (5, "1022.00", 0, "0.00", "2.00", "Pedro Pascal", 0),
        date(2026, 5, 31): (3, "3065.50", 0, "0.00", "1.67", "Maria Garcia", 0),
        date(2026, 5, 30): (3, "2670.00", 0, "0.00", "1.67", "Olena Koval", 0),
        date(2026, 5, 29): (1, "65000.00", 0, "0.00", "45.00", "Liam Neeson", 0),
    }


def test_risk_ranking(spark, scored):
    profile = reports.customer_risk_profile(
        scored, sample.accounts(spark), sample.customers(spark), sample.AS_OF
    )
    rows = {r.full_name: r for r in reports.customer_risk_ranking(profile).collect()}
    ranks = {name: (str(r.avg_risk_score), r.risk_rank) for name, r in rows.items()}
    assert ranks["Liam Neeson"] == ("45.00", 1)
    assert ranks["Pedro Pascal"] == ("10.00", 2)
    assert ranks["Olena Koval"] == ranks["Maria Garcia"] == ("2.50", 3)
    assert sum(rank == ("0.00", 5) for rank in ranks.values()) == 6
    assert {r.flagged_rank for r in rows.values()} == {1}


def test_ages(spark):
    rows = reports.customer_ages(sample.customers(spark), sample.AS_OF).orderBy("customer_id").collect()
    assert [r.age for r in rows] == [41, 35, 48, 33, 46, 30, 51, 37, 60, 27]


def test_entity_counts(spark, scored, loaded):
    counts = reports.entity_counts(
        {"customers": sample.customers(spark), "transactions": scored,
         "status_history": ingest.read_output(spark, loaded, "history")}
    )
    assert {r["entity"]: r["count"] for r in counts.collect()} == {
        "customers": 10, "transactions": 12, "status_history": 23,
    }


def test_frozen_account_cannot_be_frozen_again(spark, scored):
    requests = spark.createDataFrame([(7,), (9,), (9,), (99,)], "account_id bigint")
    result = decisions.freeze_accounts(
        requests, sample.accounts(spark), scored.drop("batch_id"), "app_user", sample.AS_OF
    )
    outcomes = {r.account_id: (r.outcome, r.reason, r.declined_count) for r in result.outcomes.collect()}
    assert outcomes == {
        7: ("refused", "not active: FROZEN", None),
        9: ("accepted", None, 1),
        99: ("refused", "not found", None),
    }
    statuses = {r.account_id: r.status for r in result.accounts.collect()}
    assert statuses[9] == "FROZEN" and statuses[1] == "ACTIVE" and len(statuses) == 10
    declined = result.transactions.filter("status = 'DECLINED'").collect()
    assert [r.transaction_id for r in declined] == [10]
    log = result.history.collect()
    assert [(r.transaction_id, r.old_status, r.new_status) for r in log] == [(10, "PENDING", "DECLINED")]


def test_cumulative_spend(spark, scored):
    rows = reports.cumulative_spend(scored, sample.accounts(spark), sample.customers(spark))
    found = {r.transaction_id: (r.customer_name, r.tx_number, r.cumulative_spent) for r in rows.collect()}
    assert found[3] == ("Olena Koval", 2, Decimal("2120.00"))
    assert found[12] == ("Sofia Muller", 2, Decimal("27.00"))
    assert 10 not in found and len(found) == 11


def test_label_and_decision_differ_at_thirty(frame):
    from vigil.functions.columns import decide, risk_label

    rows = frame([(s,) for s in (0, 29, 30, 31, 59, 60, 100)], "s int").select(
        "s", decide(F.col("s")).alias("d"), risk_label(F.col("s")).alias("l")
    )
    assert [(r.s, r.d, r.l) for r in rows.collect()] == [
        (0, "APPROVED", "LOW"), (29, "APPROVED", "LOW"), (30, "APPROVED", "MEDIUM"),
        (31, "PENDING", "MEDIUM"), (59, "PENDING", "MEDIUM"), (60, "FLAGGED", "HIGH"),
        (100, "FLAGGED", "HIGH"),
    ]

"""Whole jobs on the payment tables: each takes the tables and returns the tables that follow.

The functions in ``decisions`` compute single effects; a job here puts together all effects of one
action: status and score, history, alerts and balances.  Nothing is written except stored
intermediate results; a strict job fails on an overdraft when its accounts are computed, so write
accounts first.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed
from vigil.functions.columns import decide
from vigil.operators import keyed
from vigil.plans import decisions
from vigil.plans.scoring import history_around, transaction_scores
from vigil.session import stored


class Bank(NamedTuple):
    customers: DataFrame
    accounts: DataFrame
    cards: DataFrame
    transactions: DataFrame
    history: DataFrame
    rules: DataFrame
    alerts: DataFrame
    audit: DataFrame


class Result(NamedTuple):
    bank: Bank
    outcomes: DataFrame


def _logged(bank: Bank, rows: DataFrame) -> DataFrame:
    """History with new rows, numbered after what their transactions have already."""
    touched = rows.select("transaction_id").distinct()
    had = (
        bank.history.join(touched, "transaction_id", "left_semi")
        .groupBy("transaction_id")
        .agg(F.max("seq").alias("had"))
    )
    new = rows.join(had, "transaction_id", "left").withColumn(
        "seq", (F.col("seq") + F.coalesce("had", F.lit(0))).cast("int")
    )
    return bank.history.unionByName(new.select(*bank.history.columns))


def _alerted(bank: Bank, rows: DataFrame) -> DataFrame:
    """Alerts with new rows.  Derived alerts have no number; transaction and source are their key."""
    return bank.alerts.unionByName(rows, allowMissingColumns=True)


def _deducted(bank: Bank, deductions: DataFrame) -> DataFrame:
    kind = bank.accounts.schema["balance"].dataType
    return (
        decisions.deducted_balances(bank.accounts, deductions)
        .withColumn("balance", F.col("balance").cast(kind))
        .select(*bank.accounts.columns)
    )


def insert_transactions(bank: Bank, arrivals: DataFrame, as_of: str, strict: bool = True) -> Result:
    """Add pending transactions: scored with all rows known by then, decided, logged, deducted.

    Refused are ids that are stored already, rows that are not pending or of no known account, and all rows
    of an id whose rows differ.  Without ``strict``, approvals that overdraw their account together are
    refused too: these rows are stored, but stay pending.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    arrivals = keyed.with_defaults(
        arrivals, {"status": "PENDING", "risk_score": 0, "currency": "UAH", "transaction_at": now, "created_at": now}
    )
    columns = [c for c in bank.transactions.columns if c in arrivals.columns]
    known = bank.transactions.select("transaction_id", F.lit(True).alias("known"))
    held = bank.accounts.select("account_id", F.lit(True).alias("held"))
    judged = stored(
        keyed.settled(arrivals.select(*columns), "transaction_id")
        .join(known, "transaction_id", "left")
        .join(held, "account_id", "left")
        .withColumn(
            "reason",
            F.when(F.col("known"), "already stored")
            .when(F.col("conflict"), "conflicting repeat")
            .when(~F.col("status").eqNullSafe("PENDING"), "not pending")
            .when(F.col("held").isNull(), "unknown account"),
        ),
        "judged-arrivals",
    )
    good = judged.filter("reason IS NULL").select(*columns)
    history = history_around(good, bank.transactions, bank.accounts)
    others = [c for c in columns if c not in ("transaction_id", "risk_score", "status")]
    decided = stored(
        transaction_scores(good, bank.accounts, history, keep=others)
        .withColumn("status", decide(F.col("risk_score")))
        .select(*columns),
        "arrivals",
    )
    refused = judged.filter("reason IS NOT NULL").select("transaction_id", "reason")
    if not strict:
        over = decisions.overdrawn_accounts(bank.accounts, decided.filter("status = 'APPROVED'"))
        marked = decided.join(over.withColumn("over", F.lit(True)), "account_id", "left")
        overdraft = F.col("over").isNotNull() & (F.col("status") == "APPROVED")
        decided = stored(marked.withColumn("overdraft", overdraft), "judged-approvals")
        refused = refused.unionByName(
            decided.filter("overdraft").select("transaction_id", F.lit("overdraft").alias("reason"))
        )
        decided = decided.withColumn(
            "status", F.when(F.col("overdraft"), "PENDING").otherwise(F.col("status"))
        ).select(*columns)
    effects = decisions.arrival_outputs(decided, as_of)
    deductions = effects.balance_deltas.select(
        "transaction_id", "account_id", (-F.col("delta")).alias("amount")
    )
    following = bank._replace(
        transactions=bank.transactions.unionByName(decided, allowMissingColumns=True),
        history=_logged(bank, effects.history),
        alerts=_alerted(bank, effects.alerts),
        accounts=_deducted(bank, deductions),
    )
    outcomes = (
        decided.select("transaction_id")
        .join(refused.select("transaction_id"), "transaction_id", "left_anti")
        .select("transaction_id", F.lit("accepted").alias("outcome"), F.lit(None).cast("string").alias("reason"))
        .unionByName(refused.select("transaction_id", F.lit("refused").alias("outcome"), "reason"))
    )
    return Result(following, outcomes)


def process_transactions(
    bank: Bank, requested: DataFrame, as_of: str, strict: bool = True
) -> Result:
    """Score and decide pending transactions by id; an overdraft fails a ``strict`` job and is refused else."""
    done = decisions.process_pending(
        requested, bank.transactions, bank.accounts, bank.rules, fixed.USER_ACTOR, as_of, not strict
    )
    following = bank._replace(
        transactions=done.transactions,
        history=_logged(bank, done.history),
        alerts=_alerted(bank, done.alerts),
        accounts=_deducted(bank, done.deductions),
    )
    return Result(following, done.outcomes)


def process_in_order(bank: Bank, requests: DataFrame, as_of: str) -> Result:
    """Score and decide requests (request_no, transaction_id) one after the other, each failing alone."""
    done = decisions.process_in_order(
        requests, bank.transactions, bank.accounts, bank.rules, fixed.USER_ACTOR, as_of
    )
    following = bank._replace(
        transactions=done.transactions,
        history=_logged(bank, done.history),
        alerts=_alerted(bank, done.alerts),
        accounts=_deducted(bank, done.deductions),
    )
    return Result(following, done.outcomes)


def approve_pending(bank: Bank, as_of: str, strict: bool = True) -> Result:
    """Approve all scored low-risk pending transactions; overdrafts as in ``process_transactions``."""
    done = decisions.approve_pending(bank.transactions, bank.accounts, not strict)
    changes = done.deductions.select(
        "transaction_id", F.lit("PENDING").alias("old_status"), F.lit("APPROVED").alias("new_status")
    )
    following = bank._replace(
        transactions=done.transactions,
        history=_logged(bank, decisions.change_history(changes, fixed.USER_ACTOR, as_of)),
        accounts=_deducted(bank, done.deductions),
    )
    return Result(following, done.outcomes)


def freeze_accounts(bank: Bank, requested: DataFrame, as_of: str) -> Result:
    done = decisions.freeze_accounts(
        requested, bank.accounts, bank.transactions, fixed.USER_ACTOR, as_of
    )
    following = bank._replace(
        accounts=done.accounts,
        transactions=done.transactions,
        history=_logged(bank, done.history),
    )
    return Result(following, done.outcomes)


def delete_customers(bank: Bank, requested: DataFrame) -> Result:
    """Delete customers without accounts; audit rows lose their reference to them."""
    outcomes = decisions.customer_delete_check(requested, bank.customers, bank.accounts)
    gone = outcomes.filter("outcome = 'allowed'").select("customer_id")
    following = bank._replace(
        customers=bank.customers.join(gone, "customer_id", "left_anti"),
        audit=keyed.clear_references(bank.audit, "customer_id", gone),
    )
    return Result(following, outcomes)


def delete_transactions(bank: Bank, gone: DataFrame) -> Bank:
    """Delete transactions by id with their history and alerts."""
    ids = gone.select("transaction_id").distinct()
    return bank._replace(
        transactions=bank.transactions.join(ids, "transaction_id", "left_anti"),
        history=keyed.without_references(bank.history, "transaction_id", ids),
        alerts=keyed.without_references(bank.alerts, "transaction_id", ids),
    )


def delete_cards(bank: Bank, gone: DataFrame) -> Bank:
    """Delete cards by id; transactions lose their reference to them."""
    ids = gone.select("card_id").distinct()
    return bank._replace(
        cards=bank.cards.join(ids, "card_id", "left_anti"),
        transactions=keyed.clear_references(bank.transactions, "card_id", ids),
    )


def delete_rules(bank: Bank, gone: DataFrame) -> Bank:
    """Delete rules by id; alerts lose their reference to them."""
    ids = gone.select("rule_id").distinct()
    return bank._replace(
        rules=bank.rules.join(ids, "rule_id", "left_anti"),
        alerts=keyed.clear_references(bank.alerts, "rule_id", ids),
    )

"""Jobs that decide transactions and follow up: alerts, freezes, balances and status history.

Each takes whole tables or a table of requested ids and returns DataFrames; the caller writes them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed
from vigil.functions.columns import decide
from vigil.operators.in_order import served_in_order
from vigil.plans.scoring import history_around, transaction_scores
from vigil.session import stored

MONEY = "decimal(25,2)"


def _at(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


# Alerts.


def rule_for(reason: Column, rules: DataFrame) -> Column:
    """Lowest id among the active rules whose type the reason speaks of; NULL when there is none.

    Active rules shrink to one id per rule type, five at most, and reach the rows as one map.
    """
    lowest = (
        rules.filter(F.col("is_active") & F.col("rule_type").isin(fixed.RULE_TYPES))
        .groupBy("rule_type")
        .agg(F.min("rule_id").alias("rule_id"))
        .agg(F.map_from_entries(F.collect_list(F.struct("rule_type", "rule_id"))).alias("ids"))
        .scalar()
    )
    candidates = []
    for rule_type, texts in fixed.RULE_TEXTS.items():
        speaks = F.lit(False)
        for text in texts:
            speaks = speaks | reason.ilike(f"%{text}%")
        candidates.append(F.when(speaks, lowest.getItem(rule_type)))
    return F.least(*candidates)


def create_alerts(requests: DataFrame, rules: DataFrame, as_of: str) -> DataFrame:
    """Open alerts for (transaction_id, reason, risk_score) with their matching rule."""
    return requests.select(
        "transaction_id",
        rule_for(F.col("reason"), rules).alias("rule_id"),
        "reason",
        "risk_score",
        F.lit("OPEN").alias("alert_status"),
        _at(as_of).alias("created_at"),
        F.lit("process").alias("source"),
    )


# Status history.


def status_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(transaction_id, old_status, new_status) where the status of a known transaction differs."""
    old = before.select("transaction_id", F.col("status").alias("old_status"))
    new = after.select("transaction_id", F.col("status").alias("new_status"))
    return old.join(new, "transaction_id").filter(
        ~F.col("old_status").eqNullSafe(F.col("new_status"))
    )


def change_history(changes: DataFrame, changed_by: str, as_of: str) -> DataFrame:
    return changes.select(
        "transaction_id",
        F.lit(1).alias("seq"),
        "old_status",
        "new_status",
        F.lit(changed_by).alias("changed_by"),
        _at(as_of).alias("changed_at"),
    )


def arrival_history(scored: DataFrame, as_of: str) -> DataFrame:
    """First status of newly scored transactions, logged by the system."""
    return scored.select(
        "transaction_id",
        F.lit(0).alias("seq"),
        F.lit(None).cast("string").alias("old_status"),
        F.col("status").alias("new_status"),
        F.lit(fixed.AUTO_ACTOR).alias("changed_by"),
        _at(as_of).alias("changed_at"),
    )


def status_history(
    before: DataFrame, after: DataFrame, newly_scored: DataFrame, changed_by: str, as_of: str
) -> DataFrame:
    return change_history(status_changes(before, after), changed_by, as_of).unionByName(
        arrival_history(newly_scored, as_of)
    )


# Deciding pending transactions.


class Decisions(NamedTuple):
    transactions: DataFrame
    outcomes: DataFrame
    history: DataFrame
    alerts: DataFrame
    deductions: DataFrame


def overdrawn_accounts(accounts: DataFrame, deductions: DataFrame) -> DataFrame:
    """Ids of the accounts whose balance the deductions (account_id, amount) would take below zero."""
    sums = deductions.groupBy("account_id").agg(F.sum("amount").alias("deducted"))
    held = accounts.select("account_id", "balance")
    return sums.join(held, "account_id").filter(F.col("balance") < F.col("deducted")).select("account_id")


def _decided(ids: DataFrame, transactions: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored rows of distinct requested ids, and scores and new statuses of the pending ones among them."""
    found = stored(transactions.join(ids, "transaction_id", "left_semi"), "requested")
    pending = found.filter(F.col("status") == "PENDING")
    others = history_around(pending, transactions, accounts).join(
        pending.select("transaction_id"), "transaction_id", "left_anti"
    )
    decided = transaction_scores(pending, accounts, others, keep=["account_id", "amount"]).select(
        "transaction_id", "account_id", "amount", "risk_score", decide(F.col("risk_score")).alias("status")
    )
    return found, stored(decided, "decisions")


def _followed(
    accepted: DataFrame, outcomes: DataFrame, transactions: DataFrame, rules: DataFrame, changed_by: str, as_of: str
) -> Decisions:
    """All that follows from accepted decisions (transaction_id, account_id, amount, risk_score, status)."""
    news = accepted.select(
        "transaction_id", F.col("status").alias("new_status"), F.col("risk_score").alias("new_score")
    )
    updated = transactions.join(news, "transaction_id", "left").select(
        *(
            F.coalesce("new_status", "status").alias(c)
            if c == "status"
            else F.coalesce("new_score", "risk_score").alias(c)
            if c == "risk_score"
            else F.col(c)
            for c in transactions.columns
        )
    )
    history = change_history(
        accepted.filter(F.col("status") != "PENDING").select(
            "transaction_id", F.lit("PENDING").alias("old_status"), F.col("status").alias("new_status")
        ),
        changed_by,
        as_of,
    )
    alerts = create_alerts(
        accepted.filter(F.col("status") == "FLAGGED").select(
            "transaction_id",
            F.concat(F.lit(fixed.PROCESS_REASON), F.col("risk_score").cast("string")).alias("reason"),
            "risk_score",
        ),
        rules,
        as_of,
    )
    deductions = accepted.filter("status = 'APPROVED'").select("transaction_id", "account_id", "amount")
    return Decisions(updated, outcomes, history, alerts, deductions)


def process_pending(
    requested: DataFrame,
    transactions: DataFrame,
    accounts: DataFrame,
    rules: DataFrame,
    changed_by: str,
    as_of: str,
    refuse_overdrafts: bool = True,
) -> Decisions:
    """Score and decide the requested ids.

    Ids that are missing or not pending are refused in ``outcomes``.  So are all approvals of an account
    that they would overdraw together: they stay as they are, with the reason "overdraft".  Decisions do
    not influence each other: a score looks only at whether other transactions are DECLINED, and no
    decision declines.  Only the requested rows are scored, against the stored rows of their days and
    customers; they are read once and stored, as are the decisions that all outputs derive from.
    """
    ids = requested.select("transaction_id").distinct()
    found, decided = _decided(ids, transactions, accounts)
    if refuse_overdrafts:
        over = overdrawn_accounts(accounts, decided.filter("status = 'APPROVED'")).withColumn("over", F.lit(True))
        decided = decided.join(over, "account_id", "left").withColumn(
            "overdraft", F.col("over").isNotNull() & (F.col("status") == "APPROVED")
        )
    else:
        decided = decided.withColumn("overdraft", F.lit(False))
    accepted = decided.filter("NOT overdraft").drop("over", "overdraft")

    done = accepted.select(
        "transaction_id", F.lit(True).alias("accepted"), F.col("status").alias("new_status"), "risk_score"
    )
    asked = (
        ids.join(found.select("transaction_id", F.col("status").alias("old_status")), "transaction_id", "left")
        .join(done, "transaction_id", "left")
        .withColumn("accepted", F.col("accepted").isNotNull())
    )
    outcomes = asked.select(
        "transaction_id",
        F.when(F.col("accepted"), "accepted").otherwise("refused").alias("outcome"),
        F.when(F.col("old_status").isNull(), "not found")
        .when(F.col("old_status") != "PENDING", F.concat(F.lit("already processed: "), "old_status"))
        .when(~F.col("accepted"), "overdraft")
        .alias("reason"),
        F.coalesce("new_status", "old_status").alias("status"),
        "risk_score",
    )
    return _followed(accepted, outcomes, transactions, rules, changed_by, as_of)


def process_in_order(
    requests: DataFrame,
    transactions: DataFrame,
    accounts: DataFrame,
    rules: DataFrame,
    changed_by: str,
    as_of: str,
) -> Decisions:
    """Score and decide requests (``request_no``, ``transaction_id``) as if each were made after the one before.

    Each request stands or fails alone: an approval is refused where the account's balance, after the approvals
    before it, doesn't hold the amount, and a later smaller one may still be accepted.  What is decided is
    processed: a second request for it is refused, while one that left its transaction pending may be repeated.
    Scores do not depend on the order, since no decision declines.  ``outcomes`` has a row for every request.
    ``request_no`` occurs once.
    """
    first = requests.groupBy("transaction_id").agg(F.min("request_no").alias("place"))
    found, decided = _decided(first.select("transaction_id"), transactions, accounts)
    cents = lambda c: (F.col(c) * 100).cast("bigint")
    approvals = decided.filter("status = 'APPROVED'").join(first, "transaction_id")
    approvals = stored(approvals.withColumn("units", cents("amount")), "approvals")
    served = served_in_order(approvals, accounts.select("account_id", cents("balance").alias("held")))
    served = stored(served, "served").select(*decided.columns, "accepted")
    accepted = decided.filter("status <> 'APPROVED'").unionByName(served.filter("accepted").drop("accepted"))

    known = found.select("transaction_id", F.col("status").alias("old_status"))
    done = accepted.select("transaction_id", F.col("status").alias("new_status"), "risk_score")
    marked = first.join(known, "transaction_id", "left").join(done, "transaction_id", "left")
    asked = requests.select("request_no", "transaction_id").join(marked, "transaction_id", "left")
    old, new = F.col("old_status"), F.col("new_status")
    again = (new != "PENDING") & (F.col("request_no") != F.col("place"))
    reason = (
        F.when(old.isNull(), "not found")
        .when(old != "PENDING", F.concat(F.lit("already processed: "), old))
        .when(new.isNull(), "overdraft")
        .when(again, F.concat(F.lit("already processed: "), new))
    )
    outcomes = asked.withColumn("reason", reason).select(
        "request_no",
        "transaction_id",
        F.when(F.col("reason").isNull(), "accepted").otherwise("refused").alias("outcome"),
        "reason",
        F.coalesce(new, old).alias("status"),
        F.when(F.col("reason").isNull(), F.col("risk_score")).alias("risk_score"),
    )
    return _followed(accepted, outcomes, transactions, rules, changed_by, as_of)


class Arrivals(NamedTuple):
    history: DataFrame
    alerts: DataFrame
    balance_deltas: DataFrame


def arrival_outputs(decided: DataFrame, as_of: str) -> Arrivals:
    """What follows from arrived transactions once scored and decided.

    All arrived as PENDING, so the others changed status: two log rows each, one for the rest.
    Alerts of arrivals name no rule.
    """
    changed = decided.filter(F.col("status") != "PENDING").select(
        "transaction_id", F.lit("PENDING").alias("old_status"), F.col("status").alias("new_status")
    )
    alerts = decided.filter(F.col("status") == "FLAGGED").select(
        "transaction_id",
        F.lit(None).cast("int").alias("rule_id"),
        F.concat(F.lit(fixed.ARRIVAL_REASON), F.col("risk_score").cast("string")).alias("reason"),
        "risk_score",
        F.lit("OPEN").alias("alert_status"),
        _at(as_of).alias("created_at"),
        F.lit("arrival").alias("source"),
    )
    deltas = decided.filter(F.col("status") == "APPROVED").select(
        "transaction_id", "account_id", (-F.col("amount")).cast("decimal(15,2)").alias("delta")
    )
    return Arrivals(
        change_history(changed, fixed.USER_ACTOR, as_of).unionByName(arrival_history(decided, as_of)),
        alerts,
        deltas,
    )


class Approval(NamedTuple):
    transactions: DataFrame
    approved_count: DataFrame
    outcomes: DataFrame
    deductions: DataFrame
    overdrawn: DataFrame


def approve_pending(
    transactions: DataFrame, accounts: DataFrame, refuse_overdrafts: bool = True
) -> Approval:
    """Approve pending transactions scored 1 to the approval limit; score 0 means not scored yet.

    All approvals of an account that they would overdraw together are refused and stay pending.
    """
    low = (F.col("status") == "PENDING") & (
        (F.col("risk_score") > 0) & (F.col("risk_score") <= fixed.APPROVE_UP_TO)
    )
    asked = transactions.filter(low).select("transaction_id", "account_id", "amount")
    over = overdrawn_accounts(accounts, asked)
    if not refuse_overdrafts:
        over = over.limit(0)
    over = stored(over, "overdrawn")
    mark = over.withColumn("over", F.lit(True))
    marked = transactions.join(mark, "account_id", "left")
    snapshot = marked.withColumn(
        "status", F.when(low & F.col("over").isNull(), "APPROVED").otherwise(F.col("status"))
    ).select(*transactions.columns)
    deductions = asked.join(over, "account_id", "left_anti").select("transaction_id", "account_id", "amount")
    outcomes = asked.join(mark, "account_id", "left").select(
        "transaction_id",
        F.when(F.col("over").isNull(), "accepted").otherwise("refused").alias("outcome"),
        F.when(F.col("over").isNotNull(), "overdraft").alias("reason"),
    )
    return Approval(snapshot, deductions.agg(F.count("*").alias("approved_count")), outcomes, deductions, over)


class Freeze(NamedTuple):
    accounts: DataFrame
    transactions: DataFrame
    outcomes: DataFrame
    history: DataFrame


def freeze_accounts(
    requested: DataFrame, accounts: DataFrame, transactions: DataFrame, changed_by: str, as_of: str
) -> Freeze:
    """Freeze the requested active accounts and decline their pending transactions."""
    ids = requested.select("account_id").distinct()
    asked = ids.join(accounts.select("account_id", "status"), "account_id", "left")
    accepted = asked.filter(F.col("status") == "ACTIVE").select("account_id")

    mark = accepted.withColumn("frozen", F.lit(True))
    frozen = F.col("frozen").isNotNull()
    new_accounts = (
        accounts.join(mark, "account_id", "left")
        .withColumn("status", F.when(frozen, "FROZEN").otherwise(F.col("status")))
        .select(*accounts.columns)
    )
    hit = frozen & (F.col("status") == "PENDING")
    new_transactions = (
        transactions.join(mark, "account_id", "left")
        .withColumn("status", F.when(hit, "DECLINED").otherwise(F.col("status")))
        .select(*transactions.columns)
    )
    pending = transactions.filter(F.col("status") == "PENDING")
    declined = pending.join(accepted, "account_id", "left_semi")
    counts = pending.groupBy("account_id").agg(F.count("*").alias("n"))
    is_accepted = F.coalesce(F.col("status") == "ACTIVE", F.lit(False))
    outcomes = asked.join(counts, "account_id", "left").select(
        "account_id",
        F.when(is_accepted, "accepted").otherwise("refused").alias("outcome"),
        F.when(F.col("status").isNull(), "not found")
        .when(~is_accepted, F.concat(F.lit("not active: "), "status"))
        .alias("reason"),
        F.when(is_accepted, F.coalesce("n", F.lit(0))).alias("declined_count"),
    )
    history = change_history(
        declined.select(
            "transaction_id",
            F.col("status").alias("old_status"),
            F.lit("DECLINED").alias("new_status"),
        ),
        changed_by,
        as_of,
    )
    return Freeze(new_accounts, new_transactions, outcomes, history)


# Balances.


def deducted_balances(accounts: DataFrame, deductions: DataFrame) -> DataFrame:
    """Accounts after deductions, with the deducted amount; an overdraft fails the whole job.

    Deductions only lower a balance, so the last balance decides.  Jobs that refuse overdrafts instead
    leave them out of the deductions.
    """
    sums = deductions.groupBy("account_id").agg(F.sum("amount").cast(MONEY).alias("deducted"))
    joined = accounts.join(sums, "account_id", "left").withColumn(
        "deducted", F.coalesce("deducted", F.lit(0)).cast(MONEY)
    )
    left = (F.col("balance") - F.col("deducted")).cast(MONEY)
    message = F.concat(F.lit("overdraft of account "), F.col("account_id").cast("string"))
    return joined.select(
        *(c for c in accounts.columns if c != "balance"),
        F.when((left < 0) & (F.col("deducted") > 0), F.raise_error(message).cast(MONEY)).otherwise(left).alias("balance"),
        "deducted",
    )


# Deleting customers.


def customer_delete_check(
    requested: DataFrame, customers: DataFrame, accounts: DataFrame
) -> DataFrame:
    """Per requested id: allowed, refused (active accounts, or any account) or absent."""
    held = accounts.groupBy("customer_id").agg(
        F.count("*").alias("all_accounts"),
        F.count_if(F.col("status") == "ACTIVE").alias("active"),
    )
    known = customers.select("customer_id", F.lit(True).alias("known"))
    zero = F.lit(0).cast("bigint")
    joined = (
        requested.select("customer_id")
        .distinct()
        .join(known, "customer_id", "left")
        .join(held, "customer_id", "left")
    )
    active, every = F.coalesce("active", zero), F.coalesce("all_accounts", zero)
    return joined.select(
        "customer_id",
        F.when(F.col("known").isNull(), "absent")
        .when(active > 0, "refused: active accounts")
        .when(every > 0, "refused: accounts refer to it")
        .otherwise("allowed")
        .alias("outcome"),
        active.alias("active_accounts"),
        every.alias("accounts"),
    )

"""Reports over the payment tables.  Nothing is sorted here except where order is the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.columns import (
    age_in_years,
    full_name,
    is_risk_country,
    mask_card,
    mean_2dp,
    mean_risk_label,
    risk_label,
)
from vigil.operators.ranking import rank_by_value, value_ranks
from vigil.operators.running import running_totals
from vigil.session import stored

MONEY = "decimal(25,2)"


def _name() -> Column:
    return full_name(F.col("first_name"), F.col("last_name"))


def masked_cards(cards: DataFrame) -> DataFrame:
    return cards.select("card_id", mask_card(F.col("card_number")).alias("masked_card"))


def country_risk_flags(rows: DataFrame, country: str) -> DataFrame:
    """One row per distinct country code of the table, absent codes included."""
    return rows.select(F.col(country).alias("country_code")).distinct().withColumn(
        "is_risky", is_risk_country(F.col("country_code"))
    )


def customer_ages(customers: DataFrame, as_of: str) -> DataFrame:
    on = F.lit(as_of).cast("date")
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "birth_date",
        age_in_years(F.col("birth_date"), on).alias("age"),
    )


def customer_accounts(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    people = customers.select(
        "customer_id",
        _name().alias("full_name"),
        "email",
        "country_code",
        is_risk_country(F.col("country_code")).alias("customer_in_risk_country"),
        F.col("is_active").alias("customer_active"),
    )
    held = accounts.select(
        "customer_id",
        "account_id",
        "account_number",
        "currency",
        "balance",
        F.col("status").alias("account_status"),
        "opened_at",
    )
    return people.join(held, "customer_id")


def _with_owner(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts meet customers first: both are far smaller than the transactions."""
    owners = accounts.select("account_id", "customer_id", "account_number").join(
        customers.select("customer_id", _name().alias("customer_name"), "country_code"), "customer_id"
    )
    return transactions.join(owners, "account_id")


def recent_transactions(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame, as_of: str, days: int = 30
) -> DataFrame:
    since = F.expr(f"timestamp_ntz '{as_of}' - INTERVAL {days:d} DAY")
    recent = transactions.filter(F.col("transaction_at") >= since)
    return _with_owner(recent, accounts, customers).select(
        "transaction_id",
        "customer_id",
        "customer_name",
        "account_number",
        "amount",
        "currency",
        "merchant_category",
        "merchant_country",
        "status",
        "risk_score",
        risk_label(F.col("risk_score")).alias("risk_level"),
        "transaction_at",
    )


def transactions_with_risk_label(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    return _with_owner(transactions, accounts, customers).select(
        "transaction_id",
        F.col("customer_name").alias("customer"),
        "amount",
        "currency",
        "merchant_category",
        "merchant_country",
        "risk_score",
        "status",
        risk_label(F.col("risk_score")).alias("risk_label"),
        "transaction_at",
    )


def transactions_by_risk(transactions: DataFrame) -> DataFrame:
    """Sorted by score; the key breaks ties, which also lets the range sort split a common score."""
    return transactions.select(
        "transaction_id", "amount", "merchant_category", "merchant_country", "status", "risk_score"
    ).orderBy(F.desc("risk_score"), "transaction_id")


def flagged_transactions(
    transactions: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    alerts: DataFrame,
    rules: DataFrame,
) -> DataFrame:
    """One row per alert of a flagged transaction; alerts without a rule stay."""
    flagged = _with_owner(transactions.filter(F.col("status") == "FLAGGED"), accounts, customers)
    raised = alerts.select(
        "transaction_id",
        "rule_id",
        "alert_id",
        F.col("reason").alias("alert_reason"),
        "alert_status",
        F.col("created_at").alias("alert_created_at"),
    ).join(rules.select("rule_id", "rule_name", "rule_type"), "rule_id", "left")
    return flagged.join(raised, "transaction_id").select(
        "transaction_id",
        "customer_id",
        "customer_name",
        F.col("country_code").alias("customer_country"),
        "account_number",
        "amount",
        "currency",
        "merchant_category",
        "merchant_country",
        "risk_score",
        "transaction_at",
        "alert_id",
        "alert_reason",
        "alert_status",
        "alert_created_at",
        "rule_name",
        "rule_type",
    )


def customer_risk_profile(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame, as_of: str
) -> DataFrame:
    """Every customer, with or without accounts.  Transactions shrink to accounts before any join."""
    has = lambda status: F.count_if(F.col("status") == status)
    per_account = transactions.groupBy("account_id").agg(
        F.count("*").alias("n"),
        has("FLAGGED").alias("flagged"),
        has("APPROVED").alias("approved"),
        has("DECLINED").alias("declined"),
        F.sum(F.col("risk_score").cast("bigint")).alias("score_sum"),
        F.max("risk_score").alias("score_max"),
        F.sum(F.when(F.col("status") == "APPROVED", F.col("amount"))).alias("approved_amount"),
    )
    per_customer = (
        accounts.select("account_id", "customer_id")
        .join(per_account, "account_id")
        .groupBy("customer_id")
        .agg(
            *(F.sum(c).alias(c) for c in ["n", "flagged", "approved", "declined", "score_sum"]),
            F.max("score_max").alias("score_max"),
            F.sum("approved_amount").alias("approved_amount"),
        )
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return customers.join(per_customer, "customer_id", "left").select(
        "customer_id",
        _name().alias("full_name"),
        "email",
        "country_code",
        is_risk_country(F.col("country_code")).alias("in_high_risk_country"),
        age_in_years(F.col("birth_date"), F.lit(as_of).cast("date")).alias("age"),
        zero("n").alias("total_transactions"),
        zero("flagged").alias("flagged_count"),
        zero("approved").alias("approved_count"),
        zero("declined").alias("declined_count"),
        mean_2dp(zero("score_sum"), zero("n")).alias("avg_risk_score"),
        zero("score_max").cast("int").alias("max_risk_score"),
        zero("approved_amount").cast(MONEY).alias("total_approved_amount"),
        mean_risk_label(zero("score_sum"), zero("n")).alias("overall_risk_level"),
    )


def customer_risk_ranking(profile: DataFrame) -> DataFrame:
    """Ranks over the profile, which is stored first: it shrank all transactions to customers, and
    each rank reads it again.
    """
    profile = stored(profile, "risk-profile")
    flagged = value_ranks(profile, "flagged_count", "flagged_rank", dense=True)
    ranked = rank_by_value(profile, "avg_risk_score", "risk_rank")
    return ranked.join(flagged, F.col("flagged_count").eqNullSafe(F.col("ranked_value")), "left").select(
        "customer_id",
        "full_name",
        "country_code",
        "total_transactions",
        "flagged_count",
        "avg_risk_score",
        "overall_risk_level",
        "risk_rank",
        "flagged_rank",
    )


def cumulative_spend(
    transactions: DataFrame, accounts: DataFrame, customers: DataFrame
) -> DataFrame:
    approved = transactions.filter(F.col("status") == "APPROVED").select(
        "transaction_id", "account_id", "amount", "transaction_at"
    )
    totals = running_totals(approved, accounts)
    return totals.join(
        customers.select("customer_id", _name().alias("customer_name")), "customer_id"
    ).select(
        "customer_name", "transaction_id", "amount", "tx_number", "cumulative_spent", "transaction_at"
    )


def transaction_status_timeline(history: DataFrame, transactions: DataFrame) -> DataFrame:
    return history.join(transactions.select("transaction_id", "amount"), "transaction_id").select(
        "transaction_id", "amount", "old_status", "new_status", "changed_at", "changed_by"
    )


def status_summary(transactions: DataFrame) -> DataFrame:
    n, total = F.count("*"), F.sum(F.col("risk_score").cast("bigint"))
    return transactions.groupBy("status").agg(
        n.alias("count"), mean_2dp(total, n).alias("avg_risk")
    )


def entity_counts(entities: dict[str, DataFrame]) -> DataFrame:
    counts = [
        rows.agg(F.count("*").alias("count")).select(F.lit(name).alias("entity"), "count")
        for name, rows in entities.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# The order in which each report is presented, completed by keys so that it is total.
REPORT_ORDERS = {
    "customer_age": ["-age", "customer_id"],
    "recent_transactions": ["-transaction_at", "transaction_id"],
    "transactions_with_risk_label": ["-risk_score", "transaction_id"],
    "flagged_transactions": ["-risk_score", "-transaction_at", "transaction_id", "alert_id"],
    "customer_risk_ranking": ["risk_rank", "customer_id"],
    "daily_fraud_summary": ["-transaction_date"],
    "cumulative_spend": ["customer_name", "tx_number", "transaction_id"],
    "transaction_status_timeline": ["-changed_at", "transaction_id", "new_status"],
    "status_summary": ["-count", "status"],
    "category_revenue": ["-revenue", "category"],
}


def presented(rows: DataFrame, report: str) -> DataFrame:
    """Rows in report order, NULLs first where descending.

    A range-partitioned sort; the keys at the end let it split a value that many rows share.
    """
    return rows.orderBy(
        *(
            F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in REPORT_ORDERS[report]
        )
    )


def transaction_facts(transactions: DataFrame, history: DataFrame, alerts: DataFrame) -> DataFrame:
    """Transactions with their number of status changes, their last one's time, and their number of alerts.

    Of tables in buckets of the transaction nothing is shuffled: both sums and both joins keep the buckets.
    """
    changes = history.groupBy("transaction_id").agg(F.count("*").alias("changes"), F.max("changed_at").alias("last_changed_at"))
    raised = alerts.groupBy("transaction_id").agg(F.count("*").alias("alerts"))
    none = F.lit(0).cast("bigint")
    return (
        transactions.select("transaction_id", "account_id", "status")
        .join(changes.hint("merge"), "transaction_id", "left")
        .join(raised.hint("merge"), "transaction_id", "left")
        .select(
            "transaction_id", "account_id", "status", F.coalesce("changes", none).alias("changes"), "last_changed_at",
            F.coalesce("alerts", none).alias("alerts"),
        )
    )

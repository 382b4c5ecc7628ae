"""Daily summary of transactions, flags and alerts; computed, stored, refreshed and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.functions.columns import day_of, full_name, mean_2dp
from vigil.plans.scoring import on_days
from vigil.session import stored
from vigil.sources.layout import overwrite_partitions

MONEY = "decimal(25,2)"
TOP = 3


def _day():
    return F.to_date("transaction_at").alias("transaction_date")


def _daily_stats(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Each transaction weighs as many rows as it has alerts, at least one.

    All rows are summed by day with weight one, which shrinks the fact before any shuffle.  What the
    alerted transactions weigh beyond that is added from an inner join with their alert counts.
    """
    per_transaction = alerts.groupBy("transaction_id").agg(F.count("*").alias("alerts"))
    rows = transactions.select("transaction_at", "amount", "risk_score", "status")
    alerted = transactions.select(
        "transaction_id", "transaction_at", "amount", "risk_score", "status"
    ).join(per_transaction, "transaction_id")

    def weighted(rows: DataFrame, weight, alerts) -> DataFrame:
        # 18 whole digits for an amount times its alerts, so that sums keep cents exactly.
        amount = (F.col("amount") * weight.cast("decimal(12,0)")).cast("decimal(25,2)")
        flagged = F.col("status") == "FLAGGED"
        return rows.select(
            _day(),
            weight.alias("n"),
            amount.alias("amount"),
            F.when(flagged, weight).otherwise(0).alias("flagged"),
            F.when(flagged, amount).alias("flagged_amount"),
            (F.col("risk_score").cast("bigint") * weight).alias("score"),
            alerts.alias("alerts"),
        )

    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = weighted(rows, one, none).unionByName(weighted(alerted, F.col("alerts") - 1, F.col("alerts")))
    n, score = F.sum("n"), F.sum("score")
    return both.groupBy("transaction_date").agg(
        n.alias("total_transactions"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(MONEY).alias("total_amount"),
        F.sum("flagged").alias("flagged_transactions"),
        F.coalesce(F.sum("flagged_amount"), F.lit(0)).cast(MONEY).alias("suspicious_amount"),
        mean_2dp(score, n).alias("avg_risk_score"),
        F.sum("alerts").alias("total_fraud_alerts"),
    )


def _riskiest(transactions: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Names of the three customers with the highest mean positive score of each day."""
    per_account = (
        transactions.filter(F.col("risk_score") > 0)
        .groupBy("account_id", _day())
        .agg(F.sum(F.col("risk_score").cast("bigint")).alias("score"), F.count("*").alias("n"))
    )
    # Only customers that exist are ranked; the name is fetched for the winners alone.
    owned = accounts.select("account_id", "customer_id").join(
        customers.select("customer_id"), "customer_id", "left_semi"
    )
    per_customer = (
        per_account.join(owned, "account_id")
        .groupBy("customer_id", "transaction_date")
        .agg((F.sum("score") / F.sum("n")).alias("mean"))
    )
    order = Window.partitionBy("transaction_date").orderBy(F.desc("mean"), "customer_id")
    top = per_customer.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= TOP)
    named = top.join(
        customers.select(
            "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("name")
        ),
        "customer_id",
    )
    return named.groupBy("transaction_date").agg(
        F.expr("listagg(name, ', ') WITHIN GROUP (ORDER BY place)").alias("names")
    )


def daily_fraud_summary(
    transactions: DataFrame,
    alerts: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    as_of: str,
) -> DataFrame:
    stats = _daily_stats(transactions, alerts)
    names = _riskiest(transactions, accounts, customers)
    return stats.join(names, "transaction_date", "left").select(
        "transaction_date",
        "total_transactions",
        "total_amount",
        "flagged_transactions",
        "suspicious_amount",
        "avg_risk_score",
        F.coalesce("names", F.lit("None")).alias("top_risky_customers"),
        "total_fraud_alerts",
        F.lit(as_of).cast("timestamp_ntz").alias("last_refreshed_at"),
    )


SUMMARY = (
    "transaction_date date, total_transactions bigint, total_amount decimal(25,2), flagged_transactions bigint,"
    " suspicious_amount decimal(25,2), avg_risk_score decimal(5,2), top_risky_customers string, total_fraud_alerts bigint,"
    " last_refreshed_at timestamp_ntz"
)


def refresh_summary(summary: DataFrame, folder: str) -> str:
    """Write a full new version next to older ones; returns its path.  Readers keep theirs."""
    path = f"{folder.rstrip('/')}/version={uuid.uuid4().hex}"
    newest = F.desc("transaction_date")
    summary.repartitionByRange(newest).sortWithinPartitions(newest).write.parquet(path)
    return path


def write_summary(summary: DataFrame, folder: str) -> None:
    """Write a whole summary with a folder for each day, to be refreshed in place."""
    summary.repartitionByRange("transaction_date").write.mode("overwrite").partitionBy("transaction_date").parquet(folder)


def _days_anew(
    days: DataFrame, transactions: DataFrame, alerts: DataFrame, accounts: DataFrame, customers: DataFrame, as_of: str
) -> DataFrame:
    """Summary rows of distinct days; NULL stands for transactions without a time."""
    touched = on_days(transactions, days)
    if not days.filter("transaction_date IS NULL").isEmpty():
        touched = touched.unionByName(transactions.filter(day_of(transactions).isNull()))
    raised = alerts.join(touched.select("transaction_id"), "transaction_id", "left_semi")
    return daily_fraud_summary(touched, raised, accounts, customers, as_of)


def refreshed_days(
    summary: DataFrame,
    days: DataFrame,
    transactions: DataFrame,
    alerts: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    as_of: str,
) -> DataFrame:
    """Summary with the given ``transaction_date`` values computed anew and the others kept.

    A day that lost all its transactions loses its row.  NULL stands for transactions without a time.
    """
    named = days.select("transaction_date").distinct()
    stale = named.withColumnRenamed("transaction_date", "stale_date")
    kept = summary.join(stale, F.col("transaction_date").eqNullSafe(F.col("stale_date")), "left_anti")
    return kept.unionByName(_days_anew(named, transactions, alerts, accounts, customers, as_of))


def refresh_days(
    folder: str,
    days: DataFrame,
    transactions: DataFrame,
    alerts: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    as_of: str,
) -> None:
    """Refresh the given days of a summary stored by ``write_summary``, in place: other days keep their files.

    A day that lost all its transactions disappears.  NULL stands for transactions without a time.
    """
    named = stored(days.select("transaction_date").distinct(), "days-asked")
    fresh = stored(_days_anew(named, transactions, alerts, accounts, customers, as_of), "days-anew")
    overwrite_partitions(fresh, folder, named)


def read_summary(spark: SparkSession, path: str, flagged_only: bool = False) -> DataFrame:
    rows = spark.read.schema(SUMMARY).parquet(path).select(*spark.createDataFrame([], SUMMARY).columns)
    return rows.filter(F.col("flagged_transactions") > 0) if flagged_only else rows

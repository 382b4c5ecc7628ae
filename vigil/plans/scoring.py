"""Risk score of transactions, 0 to 100."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed
from vigil.functions.columns import day_of, is_risk_country, steps
from vigil.operators.activity import recent_activity


def own_points() -> Column:
    """Points from the transaction alone: amount, merchant country, category and hour."""
    return (
        steps(F.col("amount"), fixed.AMOUNT_STEPS, 0, inclusive=False)
        + F.when(is_risk_country(F.col("merchant_country")), fixed.COUNTRY_POINTS).otherwise(0)
        + F.when(F.col("merchant_category").isin(fixed.RISK_CATEGORIES), fixed.CATEGORY_POINTS).otherwise(0)
        + F.when(F.hour("transaction_at") <= fixed.NIGHT_LAST_HOUR, fixed.NIGHT_POINTS).otherwise(0)
    )


def _moves(transactions: DataFrame, asked: bool, keep: Sequence[str]) -> DataFrame:
    """What scoring needs and the kept columns; rows not asked for bring neither merchant nor kept."""
    kept = [F.struct(*keep).alias("kept")] if keep and asked else []
    return transactions.select(
        *kept,
        "transaction_id",
        "account_id",
        "transaction_at",
        "amount",
        F.coalesce(F.col("status") != "DECLINED", F.lit(False)).alias("counted"),
        (own_points() if asked else F.lit(0)).alias("points"),
        F.lit(asked).alias("asked"),
    )


def transaction_scores(
    transactions: DataFrame,
    accounts: DataFrame,
    history: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Score every row of ``transactions``; rows of ``history`` only add to volume and counts.

    Returns transaction_id, customer_id, daily_volume, recent_count (other transactions of the
    customer in the past hour), risk_score, and the columns of ``transactions`` named in ``keep``:
    carrying them along saves the join that would fetch them later.
    """
    moves = _moves(transactions, True, keep)
    if history is not None:
        moves = moves.unionByName(_moves(history, False, keep), allowMissingColumns=True)
    active = recent_activity(moves, accounts)
    others = F.col("past_hour_count") - F.col("counted").cast("int")
    score = (
        F.col("points")
        + steps(F.col("day_volume"), fixed.DAILY_VOLUME_STEPS, 0, inclusive=False)
        + steps(F.col("recent_count"), fixed.RECENT_COUNT_STEPS, 0, inclusive=True)
    )
    if history is not None:
        active = active.filter("asked")
    return active.withColumn("recent_count", others.cast("bigint")).select(
        "transaction_id",
        "customer_id",
        F.col("day_volume").alias("daily_volume"),
        "recent_count",
        F.least(score, F.lit(fixed.MAX_SCORE)).cast("int").alias("risk_score"),
        *(F.col(f"kept.{c}").alias(c) for c in keep),
    )


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the given days (one column of dates; NULL is none).

    Of a table laid out by day, the join reads the folders of these days alone: the planner prunes partitions by
    the broadcast days.  There is one row a calendar day at most.
    """
    day = days.columns[0]
    # The condition holds for every date; without one the planner takes the days for unselective and doesn't prune.
    listed = days.distinct().filter(F.col(day) >= F.lit("0001-01-01").cast("date")).withColumnRenamed(day, "day_asked")
    return rows.join(F.broadcast(listed), day_of(rows) == F.col("day_asked"), "left_semi")


def history_around(batch: DataFrame, stored: DataFrame, accounts: DataFrame) -> DataFrame:
    """Stored rows that can change the scores of a batch.

    They lie on the batch's dates or those of the hour before, and belong to its customers.
    """
    hour_before = F.expr("transaction_at - INTERVAL 1 HOUR")
    days = batch.select(F.explode(F.array(F.to_date("transaction_at"), F.to_date(hour_before))).alias("day"))
    owners = accounts.select("account_id", "customer_id")
    customers = owners.join(batch.select("account_id"), "account_id", "left_semi").select("customer_id")
    related = owners.join(customers, "customer_id", "left_semi").select("account_id")
    return on_days(stored, days).join(related, "account_id", "left_semi")


def customer_daily_volume(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Amount per customer and day without DECLINED rows; 0 for days with nothing else.

    Amounts are summed per account and day first, so a hot account leaves each task as one row.
    """
    per_account = transactions.groupBy(
        "account_id", F.to_date("transaction_at").alias("target_date")
    ).agg(F.sum(F.when(F.col("status") != "DECLINED", F.col("amount"))).alias("volume"))
    return (
        per_account.join(accounts.select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id", "target_date")
        .agg(F.coalesce(F.sum("volume"), F.lit(0)).cast("decimal(25,2)").alias("daily_volume"))
    )

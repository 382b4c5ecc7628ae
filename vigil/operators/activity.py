"""Recent activity per customer: same-day volume and transactions within the past hour.

One way for every customer, busy or not.  Rows are pre-aggregated to a customer's distinct instants, time is
cut into one-minute cells, and each cell gets what earlier cells carry into it, so no task ever holds a
whole customer.  The numbers of an instant are joined back to its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

JUST_PAST_HOUR = "INTERVAL '3600.000001' SECOND"


def with_customer(rows: DataFrame, accounts: DataFrame, how: str = "left") -> DataFrame:
    """Rows with the ``customer_id`` of their account.

    Accounts that fit are broadcast, by their size.  Else both sides are shuffled, and AQE splits the rows of a busy
    account over several tasks, each of which gets the one row of the account.
    """
    return rows.join(accounts.select("account_id", "customer_id"), "account_id", how)


def minute(at: str):
    return F.expr(f"{at} - make_dt_interval(0, 0, 0, extract(SECOND FROM {at}))")


def recent_activity(moves: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add ``customer_id``, ``day_volume`` and ``past_hour_count`` to every row.

    ``moves`` needs transaction_id, account_id, transaction_at, amount and ``counted`` (false for rows that add
    nothing).  The hour is closed at both ends and the row itself is in it; equal times all count.  A
    row without a time or a known account is alone: volume 0, and itself in the count.
    """
    rows = with_customer(moves, accounts)
    instants = (
        rows.filter("customer_id IS NOT NULL AND transaction_at IS NOT NULL")
        .groupBy("customer_id", "transaction_at")
        .agg(
            F.count_if("counted").alias("n"),
            F.coalesce(F.sum(F.when(F.col("counted"), F.col("amount"))), F.lit(0)).cast("decimal(25,2)").alias("volume"),
        )
    )
    # An instant counts from its time on until just past an hour later.
    changes = instants.selectExpr(
        "customer_id",
        f"""inline(array(
              named_struct('at', transaction_at, 'change', n, 'volume', volume, 'asks', true),
              named_struct('at', transaction_at + {JUST_PAST_HOUR}, 'change', -n,
                           'volume', cast(0 as decimal(25,2)), 'asks', false)))""",
    ).withColumn("cell", minute("at"))
    cells = changes.groupBy("customer_id", "cell").agg(
        F.sum("change").alias("change"), F.sum("volume").cast("decimal(25,2)").alias("volume")
    )
    # Both windows run on one partitioning by customer, over one row per minute.
    earlier = Window.partitionBy("customer_id").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    same_day = Window.partitionBy("customer_id", F.to_date("cell"))
    carried = cells.select(
        "customer_id",
        F.col("cell").alias("at"),
        F.coalesce(F.sum("change").over(earlier), F.lit(0)).alias("change"),
        (F.sum("volume").over(same_day) - F.col("volume")).cast("decimal(25,2)").alias("volume"),
        F.lit(False).alias("asks"),
        "cell",
    )
    in_cell = Window.partitionBy("customer_id", "cell")
    up_to = in_cell.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    answers = (
        changes.unionByName(carried)
        .withColumn("past_hour_count", F.sum("change").over(up_to))
        .withColumn("day_volume", F.sum("volume").over(in_cell).cast("decimal(25,2)"))
        .filter("asks")
        .select("customer_id", F.col("at").alias("transaction_at"), "past_hour_count", "day_volume")
    )
    return (
        rows.join(answers, ["customer_id", "transaction_at"], "left")
        .withColumn("past_hour_count", F.coalesce("past_hour_count", F.col("counted").cast("bigint")))
        .withColumn("day_volume", F.coalesce("day_volume", F.lit(0)).cast("decimal(25,2)"))
    )

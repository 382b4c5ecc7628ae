"""Running number and running sum per customer in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.operators.activity import minute, with_customer

ID_BLOCK = 1_000_000
MONEY = "decimal(25,2)"


def running_totals(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add customer_id, tx_number and cumulative_spent; equal times are ordered by transaction_id.

    Sums in three levels: minutes, then instants cut into blocks of ids, then rows.  The last level holds at
    most ID_BLOCK rows in a group, the others one row per cell, so no task holds a whole customer.
    Rows without a time come first; rows whose account is unknown are left out.
    """
    rows = (
        with_customer(rows, accounts, "inner")
        .filter(F.col("customer_id").isNotNull())
        .withColumn("cell", minute("transaction_at"))
        .withColumn("block", F.call_function("div", F.col("transaction_id"), F.lit(ID_BLOCK)))
    )
    blocks = rows.groupBy("customer_id", "cell", "transaction_at", "block").agg(
        F.count("*").alias("n"), F.sum("amount").cast(MONEY).alias("spent")
    )
    minutes = blocks.groupBy("customer_id", "cell").agg(
        F.sum("n").alias("n"), F.sum("spent").cast(MONEY).alias("spent")
    )

    def before(window, name):
        return F.coalesce(
            F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )

    over_minutes = Window.partitionBy("customer_id").orderBy("cell")
    minute_starts = minutes.select(
        "customer_id",
        "cell",
        F.lit(None).cast("timestamp_ntz").alias("transaction_at"),
        F.lit(None).cast("bigint").alias("block"),
        before(over_minutes, "n").alias("n"),
        before(over_minutes, "spent").cast(MONEY).alias("spent"),
        F.lit(0).alias("level"),
    )
    over_blocks = Window.partitionBy("customer_id", "cell").orderBy("level", "transaction_at", "block")
    starts = (
        minute_starts.unionByName(blocks.withColumn("level", F.lit(1)))
        .select(
            "customer_id",
            "transaction_at",
            "block",
            before(over_blocks, "n").alias("tx_number"),
            before(over_blocks, "spent").cast(MONEY).alias("value"),
            "level",
        )
        .filter("level = 1")
        .withColumn("level", F.lit(0))
    )
    last = (
        Window.partitionBy("customer_id", "transaction_at", "block")
        .orderBy("level", F.col("transaction_id").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        rows.drop("cell")
        .withColumn("tx_number", F.lit(1).cast("bigint"))
        .withColumn("value", F.col("amount").cast(MONEY))
        .withColumn("level", F.lit(1))
        .unionByName(starts, allowMissingColumns=True)
        .withColumn("cumulative_spent", F.sum("value").over(last).cast(MONEY))
        .withColumn("tx_number", F.sum("tx_number").over(last))
        .filter("level = 1")
        .drop("block", "level", "value")
    )

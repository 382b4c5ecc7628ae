"""Stored layouts of the fact tables that let frequent filters skip files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators.keyed import update_columns, with_defaults
from vigil.session import remove, stored


def write_events(
    events: DataFrame, folder: str, by_hour: bool = False, mode: str = "errorifexists"
) -> None:
    """Folders by event date, and by hour of day where asked; sorted by customer and time in a file.

    Range partitioning by date, customer and time also splits a date, or one customer of a date,
    over several files when they are large.
    """
    folders = ["event_date", "event_hour"] if by_hour else ["event_date"]
    order = [*folders, "customer_id", "event_time"]
    (
        events.withColumns({"event_date": F.to_date("event_time"), "event_hour": F.hour("event_time")})
        .drop(*({"event_hour"} - set(folders)))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .option("parquet.bloom.filter.enabled#customer_id", "true")
        .partitionBy(*folders)
        .parquet(folder)
    )


def write_orders(orders: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Folders by status and year; newest first inside a file."""
    (
        orders.withColumn("order_year", F.year("order_date"))
        .repartitionByRange("status", "order_year", "order_date", "order_id")
        .sortWithinPartitions("status", "order_year", F.desc("order_date"), "delivery_city")
        .write.mode(mode)
        .option("parquet.bloom.filter.enabled#customer_id", "true")
        .partitionBy("status", "order_year")
        .parquet(folder)
    )


def write_transactions(transactions: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Folders by day, sorted by account and time inside a file."""
    (
        transactions.withColumn("tx_date", F.to_date("transaction_at"))
        .repartitionByRange("tx_date", "account_id", "transaction_at")
        .sortWithinPartitions("tx_date", "account_id", "transaction_at")
        .write.mode(mode)
        .option("parquet.bloom.filter.enabled#account_id", "true")
        .partitionBy("tx_date")
        .parquet(folder)
    )


def append(rows: DataFrame, folder: str, schema: str, defaults: dict[str, object]) -> None:
    """Append rows to a stored table: absent columns get their default or NULL, given NULLs stay."""
    spark = rows.sparkSession
    table = spark.createDataFrame([], schema)
    full = with_defaults(rows, defaults)
    columns = [
        (F.col(c.name) if c.name in full.columns else F.lit(None)).cast(c.dataType).alias(c.name)
        for c in table.schema
    ]
    full.select(*columns).write.mode("append").parquet(folder)


def write_bucketed(
    rows: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists", folder: str | None = None
) -> DataFrame:
    """Catalog table bucketed by a join key, in the given folder if any; such tables join on it without a shuffle."""
    writer = rows.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if folder:
        writer = writer.option("path", folder)
    writer.saveAsTable(table)
    return rows.sparkSession.table(table)


# Rewriting single partitions in place.


def in_partitions(table: DataFrame, partitions: DataFrame) -> DataFrame:
    """Rows of a laid-out table in the given partitions (distinct values of its folder columns, NULLs among them).

    Other folders are not read: the planner prunes them by the broadcast values.  There are no more of them than
    folders.
    """
    by = partitions.columns
    named = partitions.select(*(F.col(c).alias(f"named_{c}") for c in by))
    full, some_null = F.lit(True), F.lit(False)
    for c in by:
        full, some_null = full & F.col(f"named_{c}").isNotNull(), some_null | F.col(c).isNull()
    same = [F.col(c) == F.col(f"named_{c}") for c in by]
    rows = table.join(F.broadcast(named.filter(full)), same, "left_semi")
    same_null = [F.col(c).eqNullSafe(F.col(f"named_{c}")) for c in by]
    return rows.unionByName(table.filter(some_null).join(F.broadcast(named.filter(~full)), same_null, "left_semi"))


def overwrite_partitions(rows: DataFrame, folder: str, asked: DataFrame, order: Sequence[str] = ()) -> None:
    """Replace the partitions ``asked`` for, and those that ``rows`` have, by ``rows``; other files stay as they are.

    Asked partitions without rows disappear.  ``rows`` must not be read from the folder: pass a stored copy.
    """
    spark, by = rows.sparkSession, asked.columns
    found = stored(rows.select(*by).distinct(), "partitions-written")
    same = [F.col(c).eqNullSafe(F.col(f"found_{c}")) for c in by]
    empty = asked.join(found.select(*(F.col(c).alias(f"found_{c}") for c in by)), same, "left_anti")
    files = spark.read.parquet(folder).select(*by, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("path"))
    left = in_partitions(files, empty).select("path").distinct()
    gone = [r.path for r in left.collect()]  # one path for each partition that disappears
    (
        rows.repartitionByRange(*by, *order)
        .sortWithinPartitions(*by, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(folder)
    )
    for path in gone:
        remove(spark, path)


def update_partitions(spark: SparkSession, folder: str, updates: DataFrame, key: str, by: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Set columns of a laid-out table for the keys of ``updates``, rewriting only partitions that hold such keys.

    An update of a folder column moves its rows: the partitions that they come to are rewritten with them.  Returns
    the rewritten partitions (values of ``by``).
    """
    table = spark.read.parquet(folder)
    keys = stored(updates, "updates")
    held = table.join(keys.select(key).distinct(), key, "left_semi").select(key, *by)
    touched = held.select(*by).distinct()
    if set(by) & set(updates.columns):
        moved = update_columns(held, keys.select(key, *(c for c in updates.columns if c in by)), key)
        touched = touched.unionByName(moved.select(*by).distinct()).distinct()
    touched = stored(touched, "partitions-touched")
    rows = stored(update_columns(in_partitions(table, touched), keys, key), "partitions-updated")
    overwrite_partitions(rows, folder, touched, order)
    return touched

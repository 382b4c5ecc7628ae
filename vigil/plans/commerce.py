"""Commerce queries: searches, top-k revenue and events, category revenue, pair counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(25,2)"
COUNTED_STATUSES = ["active", "inactive"]


def _since(as_of: str, days: int) -> Column:
    """A literal bound, so that it can be pushed to the scan."""
    return F.expr(f"timestamp_ntz '{as_of}' - INTERVAL {days:d} DAY")


def email_search(customers: DataFrame, text: str) -> DataFrame:
    return customers.filter(F.col("email").contains(text))


def orders_by_city_and_status(orders: DataFrame, text: str, status: str) -> DataFrame:
    return orders.filter(F.col("delivery_city").contains(text) & (F.col("status") == status))


def customer_revenue_top(customers: DataFrame, orders: DataFrame, k: int = 100) -> DataFrame:
    """Orders shrink to one row per customer before they meet the customers."""
    per_customer = orders.groupBy("customer_id").agg(
        F.count("*").alias("orders_count"), F.sum("total_amount").cast(MONEY).alias("revenue")
    )
    active = customers.filter(F.col("status") == "active").select("customer_id", "full_name")
    return (
        active.join(per_customer, "customer_id")
        .select("customer_id", "full_name", "orders_count", "revenue")
        .orderBy(F.col("revenue").desc_nulls_first(), "customer_id")
        .limit(k)
    )


def event_counts_top(events: DataFrame, as_of: str, days: int = 180, k: int = 200) -> DataFrame:
    """Reads three columns, of the wide event table or of its core part alike."""
    return (
        events.filter(F.col("event_time") >= _since(as_of, days))
        .groupBy("customer_id", "event_type")
        .agg(F.count("*").alias("events_count"), F.max("event_time").alias("last_event_time"))
        .orderBy(F.desc("events_count"), "customer_id", "event_type")
        .limit(k)
    )


def category_revenue(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items shrink to one row per product before they meet the products."""
    line = (F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")).cast(MONEY)
    per_product = items.groupBy("product_id").agg(
        F.count("*").alias("items"), F.sum(line).cast(MONEY).alias("revenue")
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("items").alias("items_sold"), F.sum("revenue").cast(MONEY).alias("revenue"))
    )


def order_event_pair_count(
    customers: DataFrame, orders: DataFrame, events: DataFrame, as_of: str, days: int = 90
) -> DataFrame:
    """Number of (order, recent event) pairs of the same counted customer, without forming pairs.

    Pairs outgrow 64 bits when one customer holds much of both tables, hence the wide decimal.
    """
    n_orders = orders.groupBy("customer_id").agg(F.count("*").alias("orders"))
    n_events = (
        events.filter(F.col("event_time") >= _since(as_of, days))
        .groupBy("customer_id")
        .agg(F.count("*").alias("events"))
    )
    counted = customers.filter(F.col("status").isin(COUNTED_STATUSES)).select("customer_id")
    pairs = F.col("orders").cast("decimal(19,0)") * F.col("events").cast("decimal(18,0)")
    return (
        n_orders.join(n_events, "customer_id")
        .join(counted, "customer_id")
        .agg(F.coalesce(F.sum(pairs), F.lit(0)).cast("decimal(38,0)").alias("pair_count"))
    )


def orders_with_recent_events(
    customers: DataFrame, orders: DataFrame, events: DataFrame, as_of: str, days: int = 90
) -> DataFrame:
    """Orders of counted customers that have at least one recent event."""
    recent = events.filter(F.col("event_time") >= _since(as_of, days)).select("customer_id")
    counted = customers.filter(F.col("status").isin(COUNTED_STATUSES)).select("customer_id")
    seen = counted.join(recent.distinct(), "customer_id", "left_semi")
    per_customer = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    return per_customer.join(seen, "customer_id", "left_semi").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("orders_count")
    )

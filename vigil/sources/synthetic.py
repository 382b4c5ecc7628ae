"""Generated commerce tables of any size.

Every value is a function of (seed, column, row id), so a retried task writes the same rows again.
Ids come as a DataFrame with a column ``id`` that counts from 1: ``spark.range(1, n + 1)`` or the
numbered rows of another table.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed

ATTRIBUTE_WORDS = 1000
MAX_ITEMS = fixed.ITEMS_PER_ORDER[1]


PRIME = 2**31 - 1


class Picker:
    """Values for one row id, each drawn under a column name.

    A draw squares the id twice modulo a prime, each time with the salt of its column.  That is plain
    64-bit arithmetic, which compiles to tight code, and any SQL engine can repeat it.
    """

    def __init__(self, seed: int, row: Column):
        self.seed = seed
        self.row = row.cast("bigint")

    def salt(self, name: str) -> int:
        return zlib.crc32(f"{self.seed}/{name}".encode()) % PRIME

    def number(self, name: str, below: int | Column) -> Column:
        salt = self.salt(name)
        first = (self.row + salt) % PRIME
        second = (first * first + F.call_function("div", self.row, F.lit(PRIME)) + salt) % PRIME
        third = (second * second + salt) % PRIME
        return (second * PRIME + third) % below

    def one_of(self, name: str, values: list[str]) -> Column:
        choices = F.array(*(F.lit(v) for v in values))
        return F.get(choices, self.number(name, len(values)).cast("int"))

    def between(self, name: str, bounds: tuple[int, int]) -> Column:
        low, high = bounds
        return (self.number(name, high - low + 1) + low).cast("int")

    def money(self, name: str, bounds: tuple[int, int], kind: str) -> Column:
        low, high = bounds
        cents = self.number(name, 100 * (high - low) + 1) + 100 * low
        return (cents.cast("decimal(10,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)

    def before(self, name: str, as_of: str, days: int) -> Column:
        seconds = self.number(name, days * 86400).cast("int")
        return F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))

    def word(self, name: str, prefix: str, of: int = ATTRIBUTE_WORDS) -> Column:
        return F.concat(F.lit(prefix), self.number(name, of).cast("string"))


def customers(ids: DataFrame, as_of: str, seed: int) -> DataFrame:
    p = Picker(seed, F.col("id"))
    return ids.select(
        F.col("id").alias("customer_id"),
        p.word("full_name", "Customer ").alias("full_name"),
        F.concat(
            F.lit("user"), F.col("id").cast("string"), F.lit("@"),
            p.one_of("email", ["gmail.com", "example.com", "example.org"]),
        ).alias("email"),
        p.word("phone", "+380", 10**9).alias("phone"),
        p.word("city", "City ").alias("city"),
        p.word("country", "Country ", 200).alias("country"),
        p.before("created_at", as_of, fixed.CUSTOMER_AGE_DAYS).alias("created_at"),
        p.one_of("status", fixed.CUSTOMER_STATUSES).alias("status"),
    )


def products(ids: DataFrame, as_of: str, seed: int) -> DataFrame:
    p = Picker(seed, F.col("id"))
    return ids.select(
        F.col("id").alias("product_id"),
        p.word("product_name", "product ").alias("product_name"),
        p.one_of("category", fixed.PRODUCT_CATEGORIES).alias("category"),
        p.money("price", fixed.PRICE_RANGE, "decimal(10,2)").alias("price"),
        p.word("supplier", "Supplier ").alias("supplier"),
        p.before("created_at", as_of, fixed.PRODUCT_AGE_DAYS).alias("created_at"),
    )


def orders(ids: DataFrame, n_customers: int | Column, as_of: str, seed: int) -> DataFrame:
    p = Picker(seed, F.col("id"))
    return ids.select(
        F.col("id").alias("order_id"),
        (p.number("order_customer", n_customers) + 1).alias("customer_id"),
        p.before("order_date", as_of, fixed.ORDER_AGE_DAYS).alias("order_date"),
        p.one_of("order_status", fixed.ORDER_STATUSES).alias("status"),
        p.money("total_amount", fixed.ORDER_TOTAL_RANGE, "decimal(12,2)").alias("total_amount"),
        p.one_of("payment_method", fixed.PAYMENT_METHODS).alias("payment_method"),
        p.word("delivery_city", "City ").alias("delivery_city"),
    )


def order_items(order_ids: DataFrame, n_products: int | Column, seed: int) -> DataFrame:
    """One to five lines per order; the line number makes the item id."""
    count = Picker(seed, F.col("id")).between("items", fixed.ITEMS_PER_ORDER)
    lines = order_ids.select("id", F.explode(F.sequence(F.lit(1), count)).alias("line"))
    item = (F.col("id") - 1) * MAX_ITEMS + F.col("line")
    p = Picker(seed, item)
    return lines.select(
        item.alias("order_item_id"),
        F.col("id").alias("order_id"),
        (p.number("item_product", n_products) + 1).alias("product_id"),
        p.between("quantity", fixed.QUANTITY_RANGE).alias("quantity"),
        p.money("unit_price", fixed.PRICE_RANGE, "decimal(10,2)").alias("unit_price"),
    )


def events(ids: DataFrame, n_customers: int | Column, as_of: str, seed: int) -> DataFrame:
    p = Picker(seed, F.col("id"))
    octets = [p.number(f"ip_{i}", 256).cast("string") for i in range(4)]
    return ids.select(
        F.col("id").alias("event_id"),
        (p.number("event_customer", n_customers) + 1).alias("customer_id"),
        p.one_of("event_type", fixed.EVENT_TYPES).alias("event_type"),
        p.before("event_time", as_of, fixed.EVENT_AGE_DAYS).alias("event_time"),
        p.one_of("source", fixed.EVENT_SOURCES).alias("source"),
        p.word("campaign", "campaign ").alias("campaign"),
        p.one_of("device", fixed.DEVICES).alias("device"),
        p.one_of("browser", fixed.BROWSERS).alias("browser"),
        p.one_of("os", fixed.SYSTEMS).alias("os"),
        F.concat_ws(".", *octets).alias("ip_address"),
        p.word("page_url", "https://example.com/").alias("page_url"),
        p.word("referrer", "https://example.org/").alias("referrer"),
        *(p.word(c, "word ").alias(c) for c in ("utm_source", "utm_medium", "utm_campaign")),
        *(p.word(f"attr_{i:02d}", "text ").alias(f"attr_{i:02d}") for i in range(1, 11)),
    )


def commerce_tables(
    spark, n_customers: int, n_products: int, n_orders: int, n_events: int, as_of: str, seed: int = 42
) -> dict[str, DataFrame]:
    """All five tables, sized by row counts."""
    ids = lambda n: spark.range(1, n + 1)
    return {
        "customers": customers(ids(n_customers), as_of, seed),
        "products": products(ids(n_products), as_of, seed),
        "orders": orders(ids(n_orders), n_customers, as_of, seed),
        "order_items": order_items(ids(n_orders), n_products, seed),
        "customer_events_wide": events(ids(n_events), n_customers, as_of, seed),
    }

"""Operators on keyed tables: insert absent keys, update, delete with references, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_defaults(rows: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill columns that the rows do not have; a NULL that was given stays NULL."""
    return rows.withColumns({n: F.lit(v) for n, v in defaults.items() if n not in rows.columns})


def one_per_key(rows: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest by its other columns, so a retry picks the same one."""
    others = [c for c in rows.columns if c != key]
    if not others:
        return rows.distinct()
    return (
        rows.groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
        .select(*(key if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns))
    )


def settled(rows: DataFrame, key: str) -> DataFrame:
    """One row per key with ``conflict``: whether rows of that key differ.  Equal repeats are one row."""
    others = [c for c in rows.columns if c != key]
    packed = F.struct(*others)
    return (
        rows.groupBy(key)
        .agg(F.min(packed).alias("row"), F.max(packed).alias("most"))
        .select(
            *(key if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns),
            (~F.col("row").eqNullSafe(F.col("most"))).alias("conflict"),
        )
    )


def insert_absent(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of the batch to append: one per key, and only keys the target lacks.

    Repeats collapse before the shuffle, and the join reuses the partitioning by key.
    """
    return one_per_key(batch, key).join(target.select(key), key, "left_anti")


def update_columns(table: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """New snapshot with the columns of ``updates`` set for its keys, NULLs included."""
    changed = [c for c in updates.columns if c != key]
    incoming = one_per_key(updates, key).select(
        key, F.lit(True).alias("is_updated"), *(F.col(c).alias(f"new_{c}") for c in changed)
    )
    return table.join(incoming, key, "left").select(
        *(
            F.when(F.col("is_updated"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in table.columns
        )
    )


def without_references(child: DataFrame, reference: str, deleted: DataFrame) -> DataFrame:
    """Child rows that remain when the rows they refer to are deleted with them.

    ``deleted`` has one column of keys.
    """
    keys = deleted.select(F.col(deleted.columns[0]).alias(reference))
    return child.join(keys, reference, "left_anti")


def clear_references(child: DataFrame, reference: str, deleted: DataFrame) -> DataFrame:
    """Child rows with references to deleted keys set to NULL."""
    keys = deleted.select(F.col(deleted.columns[0]).alias("gone")).distinct()
    # Rows without a reference have nothing to clear; together they would be one hot key of the join.
    without, pointing = child.filter(F.col(reference).isNull()), child.filter(F.col(reference).isNotNull())
    cleared = pointing.join(keys, F.col(reference) == F.col("gone"), "left").select(
        *(
            F.when(F.col("gone").isNull(), F.col(reference)).alias(reference) if c == reference else c
            for c in child.columns
        )
    )
    return cleared.unionByName(without)


def split_columns(wide: DataFrame, parts: list[list[str]]) -> list[DataFrame]:
    """Vertical split; each part lists its columns, the key among them."""
    return [wide.select(*columns) for columns in parts]


def join_parts(parts: list[DataFrame], key: str, hint: str | None = None) -> DataFrame:
    """Wide rows again.  All joins share one partitioning by the key; parts stored in buckets of the key bring it along,
    and the hint "merge" keeps the planner from broadcasting them."""
    wide = parts[0]
    for part in parts[1:]:
        wide = wide.join(part.hint(hint) if hint else part, key)
    return wide

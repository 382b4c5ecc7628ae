"""Audit rows from two snapshots of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _member(value: Column, name: str) -> Column:
    """``"name":value`` as JSON text, nulls included."""
    text = F.to_json(F.struct(value.alias(name)), {"ignoreNullFields": "false"})
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _object(members: list[Column]) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))


def audit_changes(
    before: DataFrame,
    after: DataFrame,
    key: str,
    columns: list[str],
    table_name: str,
    customer: str,
    as_of: str,
) -> DataFrame:
    """One row per inserted, updated or deleted key.

    Updates carry the changed ones of ``columns`` as JSON, inserts and deletes all of them.
    """
    names = dict.fromkeys([*columns, customer])  # without repeats
    side = lambda rows, mark: rows.select(
        key,
        F.struct(*(F.col(c) for c in names if c != key)).alias(mark),
    )
    pairs = side(before, "old").join(side(after, "new"), key, "full_outer")
    is_new, is_gone = F.col("old").isNull(), F.col("new").isNull()
    changed = {c: ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns}
    any_change = is_new | is_gone
    for differs in changed.values():
        any_change = any_change | differs
    members = lambda mark: [
        F.when(is_new | is_gone | changed[c], _member(F.col(f"{mark}.{c}"), c)) for c in columns
    ]
    customer_of = F.col(key)
    if customer != key:
        customer_of = F.coalesce(F.col(f"new.{customer}"), F.col(f"old.{customer}"))
    return pairs.filter(any_change).select(
        F.lit(table_name).alias("table_name"),
        F.col(key).alias("row_key"),
        customer_of.alias("customer_id"),
        F.when(is_new, "INSERT").when(is_gone, "DELETE").otherwise("UPDATE").alias("operation"),
        F.when(~is_new, _object(members("old"))).alias("old_value"),
        F.when(~is_gone, _object(members("new"))).alias("new_value"),
        F.lit(as_of).cast("timestamp_ntz").alias("changed_at"),
    )


def parse_values(audit: DataFrame) -> DataFrame:
    """Audit rows with their JSON texts as variants, for ``variant_get``."""
    return audit.withColumns(
        {c: F.parse_json(F.col(c)) for c in ("old_value", "new_value")}
    )


def changed_fields(audit: DataFrame, columns: list[str]) -> DataFrame:
    """One row per audit row and column that its values name: ``column_name, old_text, new_text``.

    Values are read from variants, so a text that holds any number of other members is parsed once.  A JSON null
    is a NULL text; a column that neither value names has no row.
    """
    names = lambda mark, c: F.expr(f"variant_get({mark}, '$.{c}') IS NOT NULL")
    text = lambda mark, c: F.expr(f"try_variant_get({mark}, '$.{c}', 'string')")
    fields = [
        F.when(
            F.coalesce(names("old_value", c), F.lit(False)) | F.coalesce(names("new_value", c), F.lit(False)),
            F.struct(F.lit(c).alias("column_name"), text("old_value", c).alias("old_text"), text("new_value", c).alias("new_text")),
        )
        for c in columns
    ]
    kept = [c for c in audit.columns if c not in ("old_value", "new_value")]
    return parse_values(audit).select(*kept, F.explode(F.array_compact(F.array(*fields))).alias("field")).select(*kept, "field.*")

"""Rows that break declared rules: value checks, absent values, lengths, keys and references."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed


class Rules(NamedTuple):
    """Declared rules of one table.

    A check is (column it reads, condition); one that evaluates to NULL holds.  ``key`` names the
    columns that tell rows apart in findings.
    """

    key: list[str]
    required: list[str]
    longest: dict[str, int]
    checks: dict[str, tuple[str, Column]]
    unique: dict[str, list[str]]


class Reference(NamedTuple):
    name: str
    child: str
    column: str
    parent: str
    parent_column: str


def payment_rules(as_of: str) -> dict[str, Rules]:
    """Rules of the payment tables."""
    col = F.col
    score = col("risk_score").between(0, fixed.MAX_SCORE)
    # \z, since $ also holds before a trailing newline.
    email = "(?i)" + fixed.EMAIL_PATTERN.removesuffix("$") + r"\z"
    return {
        "customers": Rules(
            ["customer_id"],
            ["customer_id", "first_name", "last_name", "email", "birth_date", "country_code", "is_active"],
            {"first_name": 100, "last_name": 100, "email": 255, "country_code": 2},
            {
                "email_format": ("email", col("email").rlike(email)),
                "birth_date_past": ("birth_date", col("birth_date") < F.lit(as_of).cast("date")),
            },
            {"customers_key": ["customer_id"], "customers_email": ["email"]},
        ),
        "accounts": Rules(
            ["account_id"],
            ["account_id", "customer_id", "account_number", "currency", "balance", "status", "opened_at"],
            {"account_number": 29, "currency": 3, "status": 20},
            {
                "balance_not_negative": ("balance", col("balance") >= 0),
                "account_currency": ("currency", col("currency").isin(fixed.CURRENCIES)),
                "account_status": ("status", col("status").isin(fixed.ACCOUNT_STATUSES)),
            },
            {"accounts_key": ["account_id"], "accounts_number": ["account_number"]},
        ),
        "cards": Rules(
            ["card_id"],
            ["card_id", "account_id", "card_number_hash", "card_type", "status", "expiration_date"],
            {"card_number_hash": 64, "card_type": 20, "status": 20},
            {
                "card_type": ("card_type", col("card_type").isin(fixed.CARD_TYPES)),
                "card_status": ("status", col("status").isin(fixed.CARD_STATUSES)),
            },
            {"cards_key": ["card_id"], "cards_number": ["card_number_hash"]},
        ),
        "transactions": Rules(
            ["transaction_id"],
            ["transaction_id", "account_id", "amount", "currency", "status", "risk_score", "transaction_at"],
            {"currency": 3, "merchant_category": 50, "merchant_country": 2, "status": 20},
            {
                "amount_positive": ("amount", col("amount") > 0),
                "transaction_currency": ("currency", col("currency").isin(fixed.CURRENCIES)),
                "transaction_status": ("status", col("status").isin(fixed.TRANSACTION_STATUSES)),
                "transaction_score": ("risk_score", score),
            },
            {"transactions_key": ["transaction_id"]},
        ),
        "status_history": Rules(
            ["transaction_id"],
            ["transaction_id", "new_status", "changed_at", "changed_by"],
            {"old_status": 20, "new_status": 20, "changed_by": 100},
            {},
            {"status_history_key": ["transaction_id", "seq"]},
        ),
        "fraud_rules": Rules(
            ["rule_id"],
            ["rule_id", "rule_name", "rule_type", "threshold_value", "is_active"],
            {"rule_name": 100, "rule_type": 50},
            {"rule_type": ("rule_type", col("rule_type").isin(fixed.RULE_TYPES))},
            {"fraud_rules_key": ["rule_id"], "fraud_rules_name": ["rule_name"]},
        ),
        "fraud_alerts": Rules(
            ["transaction_id", "source"],
            ["transaction_id", "source", "reason", "risk_score", "alert_status", "created_at"],
            {"alert_status": 20},
            {
                "alert_score": ("risk_score", score),
                "alert_status": ("alert_status", col("alert_status").isin(fixed.ALERT_STATUSES)),
            },
            {"fraud_alerts_key": ["transaction_id", "source"]},
        ),
        "audit_log": Rules(
            ["audit_id"],
            ["audit_id", "table_name", "operation", "changed_at"],
            {"table_name": 50, "operation": 10},
            {"audit_operation": ("operation", col("operation").isin(fixed.AUDIT_OPERATIONS))},
            {"audit_log_key": ["audit_id"]},
        ),
    }


def event_rules() -> dict[str, Rules]:
    """Keys of the split event table."""
    return {
        name: Rules(["event_id"], ["event_id"], {}, {}, {f"{name}_key": ["event_id"]})
        for name in ("events", "event_utm", "event_attributes")
    }


# References between the parts of the event table.
EVENT_REFERENCES = [
    Reference("utm_event", "event_utm", "event_id", "events", "event_id"),
    Reference("attributes_event", "event_attributes", "event_id", "events", "event_id"),
]


# References between the payment tables.
PAYMENT_REFERENCES = [
    Reference("accounts_customer", "accounts", "customer_id", "customers", "customer_id"),
    Reference("cards_account", "cards", "account_id", "accounts", "account_id"),
    Reference("transactions_account", "transactions", "account_id", "accounts", "account_id"),
    Reference("transactions_card", "transactions", "card_id", "cards", "card_id"),
    Reference("history_transaction", "status_history", "transaction_id", "transactions", "transaction_id"),
    Reference("alerts_transaction", "fraud_alerts", "transaction_id", "transactions", "transaction_id"),
    Reference("alerts_rule", "fraud_alerts", "rule_id", "fraud_rules", "rule_id"),
    Reference("audit_customer", "audit_log", "customer_id", "customers", "customer_id"),
]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _row_key(columns: list[str]) -> Column:
    return F.concat_ws("|", *(F.col(c).cast("string") for c in columns))


def _missing(rows: DataFrame, entity: str, declared: Rules) -> list[str]:
    """Declared columns that a table does not have."""
    named = [*declared.required, *declared.longest, *(c for c, _ in declared.checks.values())]
    named += [c for columns in declared.unique.values() for c in columns]
    return sorted({c for c in named if c not in rows.columns})


def check_violations(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """One row per (entity, constraint, row key) broken; each table is read once.

    A declared column that a table lacks is a violation of the table, without a row key.
    """
    found = []
    for entity, rows in tables.items():
        declared = rules[entity]
        missing = _missing(rows, entity, declared)
        broken = {f"{c}_required": F.col(c).isNull() for c in declared.required if c not in missing}
        for column, limit in declared.longest.items():
            if column not in missing:
                broken[f"{column}_length"] = F.char_length(column) > limit
        for name, (column, holds) in declared.checks.items():
            if column not in missing:
                broken[name] = ~holds
        names = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in broken.items())))
        key = [c for c in declared.key if c not in missing]
        found.append(
            rows.select(
                F.lit(entity).alias("entity"),
                F.explode(names).alias("constraint_name"),
                _row_key(key).alias("row_key"),
            )
        )
        if missing:
            lacking = F.explode(F.array(*(F.lit(f"{c}_missing") for c in missing)))
            found.append(
                rows.sparkSession.range(1).select(
                    F.lit(entity).alias("entity"), lacking.alias("constraint_name"), F.lit(None).cast("string").alias("row_key")
                )
            )
    return _union(found)


def unique_violations(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """One row per key value found more than once; keys with a NULL never collide."""
    found = []
    for entity, rows in tables.items():
        for name, columns in rules[entity].unique.items():
            if any(c not in rows.columns for c in columns):
                continue  # reported by check_violations
            present = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
            found.append(
                rows.filter(present)
                .groupBy(*columns)
                .agg(F.count("*").alias("row_count"))
                .filter("row_count > 1")
                .select(
                    F.lit(entity).alias("entity"),
                    F.lit(name).alias("constraint_name"),
                    F.concat_ws("|", *(F.col(c).cast("string") for c in columns)).alias("key_value"),
                    "row_count",
                )
            )
    return _union(found)


def reference_violations(
    tables: dict[str, DataFrame], references: list[Reference], keys: dict[str, list[str]]
) -> DataFrame:
    """One row per child row whose reference names no parent; NULL references hold.

    Children meet the parents as they are: no task collects the references it has seen, and AQE splits the rows of a
    busy reference over several tasks.
    """
    found = []
    for ref in references:
        if ref.child not in tables or ref.parent not in tables:
            continue
        # Dealt, not broadcast: compressed files look smaller than the ids that each task would hold whole.
        parents = tables[ref.parent].select(F.col(ref.parent_column).alias("wanted")).hint("shuffle_hash")
        children = tables[ref.child].select(_row_key(keys[ref.child]).alias("row_key"), F.col(ref.column).alias("wanted"))
        missing = children.filter("wanted IS NOT NULL").join(parents, "wanted", "left_anti")
        found.append(
            missing.select(
                F.lit(ref.child).alias("entity"),
                F.lit(ref.name).alias("constraint_name"),
                "row_key",
                F.col("wanted").cast("string").alias("missing_key"),
            )
        )
    return _union(found)

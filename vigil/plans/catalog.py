"""Reports and functions under SQL names, for use from ``spark.sql``.

Functions are SQL functions: Catalyst inlines them, and those that look rows up become joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil import fixed_values as fixed
from vigil.plans import reports, scoring, summary


def _texts(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def register(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    as_of: str,
    summary_path: str | None = None,
    prefix: str = "",
) -> None:
    """Create temporary views and functions, their names behind ``prefix``; runs no job.

    The daily summary is read from ``summary_path`` where given, as it was when last refreshed, and
    else computed at each use.

    ``tables`` maps customers, accounts, transactions, fraud_alerts and fraud_rules (and any others)
    to DataFrames; they become views under these names.  ``as_of`` stands for the current time.
    """
    for name, rows in tables.items():
        rows.createOrReplaceTempView(prefix + name)
    people, accounts = tables["customers"], tables["accounts"]
    transactions = tables["transactions"]
    alerts, rules = tables["fraud_alerts"], tables["fraud_rules"]
    views = {
        "vw_customer_accounts": reports.customer_accounts(people, accounts),
        "vw_recent_transactions": reports.recent_transactions(transactions, accounts, people, as_of),
        "vw_flagged_transactions": reports.flagged_transactions(
            transactions, accounts, people, alerts, rules
        ),
        "vw_customer_risk_profile": reports.customer_risk_profile(
            transactions, accounts, people, as_of
        ),
        "mv_daily_fraud_summary": summary.read_summary(spark, summary_path)
        if summary_path
        else summary.daily_fraud_summary(transactions, alerts, accounts, people, as_of),
        "customer_ages": reports.customer_ages(people, as_of),
        "customer_daily_volumes": scoring.customer_daily_volume(transactions, accounts),
        "transaction_scores": scoring.transaction_scores(transactions, accounts),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(prefix + name)

    functions = {
        "mask_card_number(number STRING) RETURNS STRING": f"""
            CASE WHEN length(number) >= 4 THEN concat('{fixed.CARD_MASK_PREFIX}', right(number, 4))
                 ELSE '{fixed.CARD_MASK_SHORT}' END""",
        "is_high_risk_country(code STRING) RETURNS BOOLEAN": f"code IN ({_texts(fixed.RISK_COUNTRIES)})",
        "get_customer_age(id BIGINT) RETURNS INT": f"""
            coalesce((SELECT max(age) FROM {prefix}customer_ages c WHERE c.customer_id = id),
                     CAST(raise_error(concat('customer not found: ', coalesce(string(id), 'NULL'))) AS INT))""",
        "calculate_customer_daily_volume(id BIGINT, day DATE) RETURNS DECIMAL(25, 2)": f"""
            coalesce((SELECT max(daily_volume) FROM {prefix}customer_daily_volumes v
                      WHERE v.customer_id = id AND v.target_date = day), 0)""",
        "calculate_transaction_risk_score(id BIGINT) RETURNS INT": f"""
            coalesce((SELECT max(risk_score) FROM {prefix}transaction_scores s WHERE s.transaction_id = id),
                     CAST(raise_error(concat('transaction not found: ', coalesce(string(id), 'NULL'))) AS INT))""",
    }
    for signature, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{signature} RETURN {body}")

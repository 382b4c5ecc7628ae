"""Column functions; all compile to built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import fixed_values as fixed


def mask_card(number: Column) -> Column:
    """Last four characters behind a mask; a bare mask when absent or too short."""
    return F.when(
        F.length(number) >= 4, F.concat(F.lit(fixed.CARD_MASK_PREFIX), F.right(number, F.lit(4)))
    ).otherwise(F.lit(fixed.CARD_MASK_SHORT))


def is_risk_country(code: Column) -> Column:
    """NULL stays NULL."""
    return code.isin(fixed.RISK_COUNTRIES)


def age_in_years(birth: Column, on: Column) -> Column:
    """Full years; a birthday on Feb 29 falls on Mar 1 in common years."""
    month_day = lambda day: F.month(day) * 100 + F.dayofmonth(day)
    return F.year(on) - F.year(birth) - (month_day(on) < month_day(birth)).cast("int")


def full_name(first: Column, last: Column) -> Column:
    """NULL when either part is."""
    return F.concat(first, F.lit(" "), last)


def steps(value: Column, table: list[tuple[int, object]], otherwise: object, inclusive: bool) -> Column:
    """First entry of a highest-first step table whose bound the value passes."""
    result = None
    for bound, outcome in table:
        passed = value >= bound if inclusive else value > bound
        result = F.when(passed, outcome) if result is None else result.when(passed, outcome)
    return result.otherwise(otherwise)


def risk_label(score: Column) -> Column:
    return steps(score, fixed.LABEL_STEPS, fixed.LABEL_OTHERWISE, inclusive=True)


def mean_risk_label(total: Column, n: Column) -> Column:
    """Label of the unrounded mean total/n, compared in whole numbers."""
    result = None
    for bound, label in fixed.LABEL_STEPS:
        passed = (n > 0) & (total >= bound * n)
        result = F.when(passed, label) if result is None else result.when(passed, label)
    return result.otherwise(fixed.LABEL_OTHERWISE)


def mean_2dp(total: Column, n: Column) -> Column:
    """Mean of non-negative whole numbers as DECIMAL(5,2), halves up, 0.00 for no rows."""
    cents = F.call_function("div", total * 200 + n, F.nullif(n, F.lit(0)) * 2)
    exact = F.coalesce(cents, F.lit(0)).cast("decimal(7,0)") * F.lit("0.01").cast("decimal(3,2)")
    return exact.cast("decimal(5,2)")


def day_of(rows: DataFrame) -> Column:
    """Day of a transaction: the folder column of a table laid out by day, where there is one."""
    return F.col("tx_date") if "tx_date" in rows.columns else F.to_date("transaction_at")


def decide(score: Column) -> Column:
    """Status that follows from a score."""
    return (
        F.when(score >= fixed.FLAG_FROM, "FLAGGED")
        .when(score <= fixed.APPROVE_UP_TO, "APPROVED")
        .otherwise("PENDING")
    )

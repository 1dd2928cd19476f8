"""Derived loan measures as plain Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Division that reads 0.0 where the denominator is zero (safe under ANSI)."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(numerator / denominator)


def current_ltv() -> Column:
    return ratio_or_zero(F.col("current_balance"), F.col("property_value_current"))


def original_lti() -> Column:
    return ratio_or_zero(F.col("original_principal"), F.col("gross_household_income"))


def ltv_at_origination() -> Column:
    return ratio_or_zero(F.col("original_principal"), F.col("property_value_at_origination"))


def stage_pd() -> Column:
    """12-month PD in stage 1, lifetime PD elsewhere."""
    return F.when(F.col("ifrs9_stage") == "1", F.col("pd_12m")).otherwise(F.col("pd_lifetime"))


def expected_loss(pd: Column | None = None, lgd: Column | None = None) -> Column:
    pd = stage_pd() if pd is None else pd
    lgd = F.col("lgd") if lgd is None else lgd
    return pd * lgd * F.col("ead")


def with_derived_fields(tape: DataFrame) -> DataFrame:
    return tape.withColumns(
        {
            "current_ltv": current_ltv(),
            "original_lti": original_lti(),
            "expected_loss": expected_loss(),
        }
    )


def scan_ltv(columns: list[str]) -> Column:
    """Loan-to-value as the quick scan reads it.

    A stored ``current_ltv`` wins; otherwise a zero valuation counts as 1.0.
    """
    if "current_ltv" in columns:
        return F.col("current_ltv")
    value = F.col("property_value_current")
    return F.col("current_balance") / F.when(value == 0, F.lit(1.0)).otherwise(value)


def calendar_months(start: Column, end: Column) -> Column:
    """Whole calendar months between two dates; the day of month is ignored."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def as_date(value: date | Column | None) -> Column:
    """A date literal; today when no reference date is given."""
    if value is None:
        return F.current_date()
    return value if isinstance(value, Column) else F.lit(value)


def vintage() -> Column:
    return F.year(F.col("origination_date"))


def pc4() -> Column:
    return F.substring(F.col("pc6"), 1, 4)

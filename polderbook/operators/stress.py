"""Stress scenarios.

A scenario replaces PD or LGD on the loans it touches; everything else is shared:
expected loss before and after, a waterfall and its checks. All shock sizes and
response strengths are arguments, none is a published value.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import expected_loss, ratio_or_zero, stage_pd

# ---- fixed values: loss curve over current LTV --------------------------------
LGD_FREE_LTV = 0.6
LGD_SLOPE = 0.5
# ---- fixed value: the rate reset of the published scenario ---------------------
RESET_BASIS_POINTS = 200.0


def loss_curve(ltv: Column) -> Column:
    return F.greatest(F.lit(0.0), ltv - LGD_FREE_LTV) * LGD_SLOPE


def clip_unit(value: Column) -> Column:
    """Into [0, 1]; null and NaN stay, where ``least`` alone would make them 1."""
    return F.when(F.isnan(value), value).when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def _stressed(tape: DataFrame, pd: Column | None = None, lgd: Column | None = None) -> DataFrame:
    """The tape with base and stressed PD, LGD and expected loss."""
    frame = tape.withColumns(
        {
            "base_pd": stage_pd(),
            "stressed_pd": stage_pd() if pd is None else pd,
            "stressed_lgd": F.col("lgd") if lgd is None else lgd,
        }
    )
    return frame.withColumns(
        {
            "base_el": expected_loss(F.col("base_pd")),
            "stressed_el": expected_loss(F.col("stressed_pd"), F.col("stressed_lgd")),
        }
    )


def _revalued(tape: DataFrame, factor: Column) -> DataFrame:
    """Property values times ``factor``; LGD follows the loss curve, NHG loans keep theirs."""
    value, balance = F.col("property_value_current"), F.col("current_balance")
    before = ratio_or_zero(balance, value)
    after = ratio_or_zero(balance, value * factor)
    shifted = clip_unit(F.col("lgd") + loss_curve(after) - loss_curve(before))
    return _stressed(tape, lgd=F.when(F.col("nhg_flag"), F.col("lgd")).otherwise(shifted))


def _burdened(tape: DataFrame, yearly_cost: Column, pd_response: float) -> DataFrame:
    """PD scaled up by the yearly cost relative to household income."""
    burden = ratio_or_zero(yearly_cost, F.col("gross_household_income"))
    return _stressed(tape, pd=F.least(F.lit(1.0), stage_pd() * (1 + burden * pd_response)))


def house_price_shock(tape: DataFrame, shock: float) -> DataFrame:
    """All property values times ``1 + shock``; a fall is a negative shock."""
    if shock <= -1.0:
        raise ValueError("a price shock must leave a positive value")
    return _revalued(tape, F.lit(1.0 + shock))


def hra_phase_out(tape: DataFrame, new_rate: float, pd_response: float) -> DataFrame:
    """Eligible loans lose the deduction above ``new_rate`` on their yearly interest."""
    lost = F.greatest(F.lit(0.0), F.col("hra_phase_out_rate") - new_rate)
    cost = F.when(
        F.col("tax_deduction_eligible"), F.col("current_balance") * F.col("interest_rate") * lost
    ).otherwise(F.lit(0.0))
    return _burdened(tape, cost, pd_response)


def rate_reset(
    tape: DataFrame, start: date, end: date, pd_response: float,
    basis_points: float = RESET_BASIS_POINTS,
) -> DataFrame:
    """Loans whose fixed rate ends in the window pay ``basis_points`` more per year."""
    resets = F.coalesce(F.col("rentevast_einddatum").between(F.lit(start), F.lit(end)), F.lit(False))
    cost = F.when(resets, F.col("current_balance") * (basis_points / 10000.0)).otherwise(
        F.lit(0.0)
    )
    return _burdened(tape, cost, pd_response)


def energy_transition(tape: DataFrame, discounts: Mapping[str, float]) -> DataFrame:
    """Property values fall by a discount per energy label."""
    factor = F
    for label, discount in discounts.items():
        factor = factor.when(F.col("energy_label") == label, F.lit(1.0 - discount))
    return _revalued(tape, factor.otherwise(F.lit(1.0)))


def stress_summary(stressed: DataFrame, by: str = "ifrs9_stage") -> DataFrame:
    """Expected loss before and after per segment: the steps of the waterfall."""
    return stressed.groupBy(F.col(by).alias("segment")).agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum("base_el").alias("base_el"),
        F.sum("stressed_el").alias("stressed_el"),
        F.sum(F.col("stressed_el") - F.col("base_el")).alias("el_delta"),
        F.count_if(~is_finite(F.col("stressed_el"))).alias("non_finite"),
    )


def is_finite(value: Column) -> Column:
    limit = F.lit(float("inf"))
    return value.isNotNull() & ~F.isnan(value) & (value != limit) & (value != -limit)


def stress_check(
    stressed: DataFrame, sanity_bound: float, by: str = "ifrs9_stage", tolerance: float = 1.0
) -> DataFrame:
    """One row: totals, waterfall gap and status.

    FAILED on a non-finite result, a waterfall that does not add up within
    ``tolerance`` EUR, or a delta beyond three times the sanity bound.
    """
    steps = stress_summary(stressed, by)
    totals = steps.agg(
        F.sum("base_el").alias("base_el"),
        F.sum("stressed_el").alias("stressed_el"),
        F.sum("el_delta").alias("el_delta"),
        F.sum("non_finite").alias("non_finite"),
    )
    gap = F.abs(F.col("stressed_el") - F.col("base_el") - F.col("el_delta"))
    # A NaN gap compares as larger than any tolerance.
    bad = (
        (F.col("non_finite") > 0) | (gap > tolerance)
        | (F.abs(F.col("el_delta")) > 3 * sanity_bound)
    )
    return totals.withColumn("waterfall_gap", gap).withColumn(
        "status", F.when(bad, F.lit("FAILED")).otherwise(F.lit("OK"))
    )

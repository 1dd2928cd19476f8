"""Significant-increase-in-credit-risk triggers and the stage they imply."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import as_date, calendar_months

# ---- fixed values: trigger thresholds ----------------------------------------
PD_RATIO = 2.5
PD_UPLIFT = 0.005
BACKSTOP_DAYS = 30
FORBEARANCE_MONTHS = 24
OVERLAY_MONTHS = 12
OVERLAY_DSCR = 1.2
CLIMATE_LABELS = ("E", "F", "G")
CLIMATE_BUILT_BEFORE = 1992
IMPAIRED_DAYS = 90

ORIGINATION_PD = "pd_lifetime_at_origination"
RESTRUCTURED_ON = "restructured_date"


def triggers(columns: list[str], reference_date: date | Column | None = None) -> dict[str, Column]:
    """One condition per trigger, in reporting order.

    Two triggers use columns a tape may lack. Without the PD at origination the
    quantitative trigger is null (not assessed); without a restructuring date the
    flag alone decides on forbearance.
    """
    reference = as_date(reference_date)
    lifetime = F.col("pd_lifetime")
    if ORIGINATION_PD in columns:
        at_start = F.col(ORIGINATION_PD)
        quantitative = (lifetime > at_start * PD_RATIO) & (lifetime - at_start > PD_UPLIFT)
    else:
        quantitative = F.lit(None).cast("boolean")
    forborne = F.col("restructured_flag")
    if RESTRUCTURED_ON in columns:
        age = calendar_months(F.col(RESTRUCTURED_ON), reference)
        forborne = forborne & F.coalesce(age <= FORBEARANCE_MONTHS, F.lit(True))
    fix_ends = F.col("rentevast_einddatum").between(
        reference, F.add_months(reference, OVERLAY_MONTHS)
    )
    return {
        "QUANT_PD_INCREASE": quantitative,
        "DPD_30_BACKSTOP": F.col("days_past_due") >= BACKSTOP_DAYS,
        "FORBEARANCE": forborne,
        "WATCHLIST": F.col("watchlist_flag"),
        "MACRO_OVERLAY": F.coalesce(fix_ends, F.lit(False)) & (F.col("dscr") < OVERLAY_DSCR),
        "CLIMATE_TRANSITION": F.col("energy_label").isin(*CLIMATE_LABELS)
        & (F.col("bouwjaar") < CLIMATE_BUILT_BEFORE),
    }


def sicr_triggers(
    tape: DataFrame, reference_date: date | Column | None = None, promote_climate: bool = True
) -> DataFrame:
    """The tape with ``sicr_<trigger>`` flags, ``sicr_reasons`` and ``derived_stage``.

    The climate trigger is a soft indicator: it is always reported and promotes
    to stage 2 unless ``promote_climate`` is off. Map-only.
    """
    found = triggers(tape.columns, reference_date)
    flags = {f"sicr_{name.lower()}": condition for name, condition in found.items()}
    flagged = tape.withColumns(flags)
    promoting = [
        F.coalesce(F.col(flag), F.lit(False))
        for flag in flags
        if promote_climate or flag != "sicr_climate_transition"
    ]
    any_trigger = F.lit(False)
    for condition in promoting:
        any_trigger = any_trigger | condition
    impaired = (F.col("days_past_due") >= IMPAIRED_DAYS) | F.col("unlikely_to_pay_flag")
    reasons = F.concat_ws(
        ",", *[F.when(F.col(flag), F.lit(name)) for name, flag in zip(found, flags)]
    )
    return flagged.withColumns(
        {
            "sicr_reasons": reasons,
            "derived_stage": F.when(impaired, F.lit("3"))
            .when(any_trigger, F.lit("2"))
            .otherwise(F.lit("1")),
        }
    )


def trigger_counts(
    tape: DataFrame, reference_date: date | Column | None = None
) -> DataFrame:
    """Loans hit per trigger, from one global aggregate."""
    found = triggers(tape.columns, reference_date)
    totals = tape.agg(*[F.count_if(c).alias(name) for name, c in found.items()])
    return totals.select(
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("trigger"), F.col(name).alias("loan_count"))
            for name in found
        ]))
    )


def stage_transitions(
    tape: DataFrame, reference_date: date | Column | None = None, promote_climate: bool = True
) -> DataFrame:
    """Reported against derived stage."""
    staged = sicr_triggers(tape, reference_date, promote_climate)
    return staged.groupBy(
        F.col("ifrs9_stage").alias("reported_stage"), "derived_stage"
    ).agg(F.count(F.lit(1)).alias("loan_count"), F.sum("current_balance").alias("exposure"))


def trigger_quality(
    labelled: DataFrame, expected: Column, reference_date: date | Column | None = None
) -> DataFrame:
    """Recall and specificity of promotion against an ``expected`` condition per loan."""
    staged = sicr_triggers(labelled, reference_date)
    promoted = F.col("derived_stage") >= "2"
    return staged.agg(
        F.try_divide(F.count_if(expected & promoted), F.count_if(expected)).alias("recall"),
        F.try_divide(F.count_if(~expected & ~promoted), F.count_if(~expected)).alias(
            "specificity"
        ),
    )

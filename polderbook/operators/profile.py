"""Share and assertion profiles of a tape, each a single aggregate."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import vintage
from polderbook.model import PC6_PATTERN

OLD_STOCK_BEFORE = 1992
NEW_STOCK_FROM = 2015
RESET_WINDOW = (date(2025, 1, 1), date(2028, 12, 31))


def conditional_share(condition: Column, within: Column) -> Column:
    """Share of the rows meeting ``condition`` among those meeting ``within`` (null if none do)."""
    return F.try_divide(F.count_if(condition & within), F.count_if(within))


def reset_wave() -> Column:
    return F.coalesce(F.col("rentevast_einddatum").between(*RESET_WINDOW), F.lit(False))


def share_profile(tape: DataFrame) -> DataFrame:
    originated, built = F.col("origination_date"), F.col("bouwjaar")
    label = F.col("energy_label")
    return tape.agg(
        conditional_share(
            F.col("repayment_type") == "ANNUITEIT", originated >= F.lit(date(2014, 1, 1))
        ).alias("annuity_share_post_2013"),
        conditional_share(
            F.col("repayment_type").isin("AFLOSSINGSVRIJ", "SPAAR", "HYBRIDE"),
            originated < F.lit(date(2013, 1, 1)),
        ).alias("legacy_share_pre_2013"),
        conditional_share(
            label.isin("C", "D", "E", "F", "G"), built < OLD_STOCK_BEFORE
        ).alias("low_label_share_old_stock"),
        conditional_share(
            label.isin("A++++", "A+++", "A++", "A+", "A"), built >= NEW_STOCK_FROM
        ).alias("high_label_share_new_stock"),
        conditional_share(reset_wave(), F.lit(True)).alias("reset_wave_share"),
    )


def assertion_profile(tape: DataFrame) -> DataFrame:
    return tape.agg(
        F.bool_and(F.col("pc6").rlike(PC6_PATTERN)).alias("all_pc6_valid"),
        F.bool_and(F.col("currency") == "EUR").alias("all_currency_eur"),
        F.min(vintage()).alias("min_vintage"),
        F.max(vintage()).alias("max_vintage"),
        F.count_distinct("energy_label").alias("energy_label_count"),
    )

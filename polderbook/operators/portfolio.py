"""Portfolio breakdowns: each a small group-by whose partial sums are built in the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.functions.derived import current_ltv, expected_loss, pc4, vintage
from polderbook.model import ARREARS_BUCKETS
from polderbook.operators.kpis import share, weighted_mean
from polderbook.operators.profile import NEW_STOCK_FROM, OLD_STOCK_BEFORE

RESET_YEARS = (2025, 2028)

_BALANCE = "current_balance"


def _exposure() -> list[Column]:
    return [F.count(F.lit(1)).alias("loan_count"), F.sum(_BALANCE).alias("exposure")]


def total_exposure(tape: DataFrame) -> Column:
    """Total balance as a scalar subquery, so shares need no window over the groups."""
    return tape.agg(F.sum(_BALANCE)).scalar()


def _with_exposure_share(groups: DataFrame, tape: DataFrame) -> DataFrame:
    return groups.withColumn("exposure_share", share(F.col("exposure"), total_exposure(tape)))


def vintage_arrears(tape: DataFrame) -> DataFrame:
    """Loans, exposure and share of the vintage per origination year and arrears bucket."""
    cells = tape.groupBy(vintage().alias("vintage"), "arrears_bucket").agg(*_exposure())
    # Five buckets per year: the window sees aggregated cells only.
    year = Window.partitionBy("vintage")
    return cells.withColumn(
        "share_of_vintage", F.col("loan_count") / F.sum("loan_count").over(year)
    )


def vintage_arrears_matrix(tape: DataFrame) -> DataFrame:
    """The same counts with one column per bucket."""
    return (
        tape.groupBy(vintage().alias("vintage"))
        .pivot("arrears_bucket", list(ARREARS_BUCKETS))
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def concentration(tape: DataFrame, area: Column, name: str, top: int | None = None) -> DataFrame:
    """Exposure by area, largest first; ``top`` keeps the leading areas of the report."""
    groups = _with_exposure_share(tape.groupBy(area.alias(name)).agg(*_exposure()), tape)
    ranked = groups.orderBy(F.desc("exposure"), name)
    return ranked if top is None else ranked.limit(top)


def concentration_pc4(tape: DataFrame, top: int | None = None) -> DataFrame:
    return concentration(tape, pc4(), "pc4", top)


def concentration_gemeente(tape: DataFrame, top: int | None = None) -> DataFrame:
    return concentration(tape, F.col("gemeente"), "gemeente", top)


def borrower_concentration(tape: DataFrame, top: int) -> DataFrame:
    """The ``top`` borrowers by exposure over all their loans.

    Borrowers are many: the total is a subquery and the ranking a top-n per task,
    so nothing funnels the borrower table through one place.
    """
    return concentration(tape, F.col("borrower_id"), "borrower_id", top)


def ltv_bands(tape: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Loans and exposure by current LTV; bands are ``[edge, next edge)`` with open ends."""
    bounds = sorted(edges)
    ltv = current_ltv()
    band = F.when(ltv < bounds[0], F.lit(0))
    for i, edge in enumerate(bounds[1:], start=1):
        band = band.when(ltv < edge, F.lit(i))
    band = band.otherwise(F.lit(len(bounds)))
    lows = F.array(F.lit(None).cast("double"), *[F.lit(float(b)) for b in bounds])
    highs = F.array(*[F.lit(float(b)) for b in bounds], F.lit(None).cast("double"))
    groups = tape.groupBy(band.alias("band")).agg(*_exposure())
    return _with_exposure_share(groups, tape).select(
        "band",
        F.get(lows, F.col("band")).alias("ltv_from"),
        F.get(highs, F.col("band")).alias("ltv_to"),
        "loan_count", "exposure", "exposure_share",
    ).orderBy("band")


def rentevast_waterfall(tape: DataFrame) -> DataFrame:
    """Exposure by the year in which the fixed rate ends (null: variable rate)."""
    groups = tape.groupBy(F.year("rentevast_einddatum").alias("expiry_year")).agg(*_exposure())
    return _with_exposure_share(groups, tape).withColumn(
        "in_reset_wave", F.coalesce(F.col("expiry_year").between(*RESET_YEARS), F.lit(False))
    ).orderBy("expiry_year")


def construction_band() -> Column:
    built = F.col("bouwjaar")
    return (
        F.when(built < OLD_STOCK_BEFORE, F.lit(f"<{OLD_STOCK_BEFORE}"))
        .when(built < NEW_STOCK_FROM, F.lit(f"{OLD_STOCK_BEFORE}-{NEW_STOCK_FROM - 1}"))
        .otherwise(F.lit(f">={NEW_STOCK_FROM}"))
    )


def energy_by_age(tape: DataFrame) -> DataFrame:
    groups = tape.groupBy("energy_label", construction_band().alias("built")).agg(*_exposure())
    return _with_exposure_share(groups, tape)


def rwa_density(tape: DataFrame) -> DataFrame:
    """Risk-weighted assets, exposure at default and their ratio."""
    return tape.agg(
        F.coalesce(F.sum(F.col("risk_weight") * F.col("ead")), F.lit(0.0)).alias("rwa"),
        F.coalesce(F.sum("ead"), F.lit(0.0)).alias("ead"),
        weighted_mean(F.col("risk_weight"), F.col("ead")).alias("rwa_density"),
    )


def ecl_by_stage(tape: DataFrame) -> DataFrame:
    return tape.groupBy("ifrs9_stage").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum("ead").alias("ead"),
        F.sum(expected_loss()).alias("ecl"),
        share(F.sum(expected_loss()), F.sum("ead")).alias("coverage"),
    )


def vintage_trend(tape: DataFrame) -> DataFrame:
    """Key indicators per vintage and their change on the year before in the table."""
    balance = F.col(_BALANCE)
    years = tape.groupBy(vintage().alias("vintage")).agg(
        *_exposure(),
        weighted_mean(F.col("pd_12m"), balance).alias("weighted_pd_12m"),
        weighted_mean(current_ltv(), balance).alias("weighted_ltv"),
        share(F.count_if("nhg_flag"), F.count(F.lit(1))).alias("nhg_share"),
    )
    # One row per calendar year, hence a window without a partition key.
    order = Window.orderBy("vintage")
    return years.withColumns(
        {
            "pd_change": F.col("weighted_pd_12m") - F.lag("weighted_pd_12m").over(order),
            "ltv_change": F.col("weighted_ltv") - F.lag("weighted_ltv").over(order),
        }
    )

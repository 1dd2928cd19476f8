"""Quick-scan portfolio indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import current_ltv, scan_ltv, vintage
from polderbook.model import STAGES


def share(part: Column, whole: Column) -> Column:
    """A share that reads 0.0 when there is nothing to divide by."""
    return F.when(F.coalesce(whole, F.lit(0)) == 0, F.lit(0.0)).otherwise(part / whole)


def weighted_mean(value: Column, weight: Column) -> Column:
    """Sum(value * weight) / sum(weight); 0.0 for a zero weight. A NaN stays a NaN."""
    return share(F.sum(value * weight), F.sum(weight))


def row_count(frame: DataFrame) -> Column:
    """Rows of ``frame`` as a scalar subquery (Parquet answers it from the footers)."""
    return frame.agg(F.count(F.lit(1))).scalar()


def quick_scan_kpis(tape: DataFrame) -> DataFrame:
    """One row of indicators; zeros for an empty tape.

    Everything but the borrower count is a single aggregate without a shuffle key.
    Distinct borrowers are counted in a subquery of their own: next to the sums
    they would drag every partial sum through a shuffle by borrower. A null
    borrower counts as one.
    """
    borrowers = tape.select("borrower_id").distinct()
    return tape.agg(
        F.count(F.lit(1)).alias("loan_count"),
        *[value.alias(name) for name, value in scan_indicators(tape.columns).items()],
    ).select(
        "loan_count",
        row_count(borrowers).alias("borrower_count"),
        "total_exposure",
        "weighted_avg_pd_12m",
        "weighted_avg_pd_lifetime",
        "weighted_avg_current_ltv",
        "weighted_avg_hra_phase_out_rate",
        "nhg_share",
        "aflossingsvrij_share",
        "weighted_avg_current_ltv_safe",
    )


def scan_indicators(columns: list[str]) -> dict[str, Column]:
    """The indicators that are amounts or shares, as plain aggregates over a tape with ``columns``."""
    balance = F.col("current_balance")
    rows = F.count(F.lit(1))
    return {
        "total_exposure": F.coalesce(F.sum(balance), F.lit(0.0)),
        "weighted_avg_pd_12m": weighted_mean(F.col("pd_12m"), balance),
        "weighted_avg_pd_lifetime": weighted_mean(F.col("pd_lifetime"), balance),
        "weighted_avg_current_ltv": weighted_mean(scan_ltv(columns), balance),
        "weighted_avg_hra_phase_out_rate": weighted_mean(F.col("hra_phase_out_rate"), balance),
        "nhg_share": share(F.count_if("nhg_flag"), rows),
        "aflossingsvrij_share": share(F.count_if(F.col("repayment_type") == "AFLOSSINGSVRIJ"), rows),
        # Zero valuations count as 0.0 here instead of blowing up the mean.
        "weighted_avg_current_ltv_safe": weighted_mean(_safe_ltv(columns), balance),
    }


def _safe_ltv(columns: list[str]) -> Column:
    return F.col("current_ltv") if "current_ltv" in columns else current_ltv()


def mix(tape: DataFrame, column: str, always: tuple[str, ...] = ()) -> DataFrame:
    """``dimension, key, share`` by number of loans; ``always`` lists keys shown even when absent."""
    keys = tape.select(
        F.coalesce(F.col(column).cast("string"), F.lit("None")).alias("key"), F.lit(1).alias("n")
    )
    if always:
        empty = tape.sparkSession.createDataFrame([(k, 0) for k in always], "key string, n int")
        keys = keys.unionByName(empty)
    return keys.groupBy("key").agg(F.sum("n").alias("n")).select(
        F.lit(column).alias("dimension"), "key", share(F.col("n"), row_count(tape)).alias("share")
    )


def stage_mix(tape: DataFrame) -> DataFrame:
    return mix(tape, "ifrs9_stage", always=STAGES)


def energy_label_mix(tape: DataFrame) -> DataFrame:
    return mix(tape, "energy_label")


def vintage_histogram(tape: DataFrame) -> DataFrame:
    return (
        tape.groupBy(vintage().alias("year"))
        .agg(F.count(F.lit(1)).alias("loan_count"))
        .orderBy("year")
    )


def quick_scan(tape: DataFrame) -> dict:
    """The indicators and both mixes as one plain dictionary (a few dozen values)."""
    kpis = quick_scan_kpis(tape).first().asDict()
    kpis["ifrs9_stage_mix"] = {r["key"]: r["share"] for r in stage_mix(tape).collect()}
    kpis["energy_label_mix"] = {r["key"]: r["share"] for r in energy_label_mix(tape).collect()}
    return kpis

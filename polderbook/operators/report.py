"""Tables of the validation report."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.functions.derived import as_date
from polderbook.operators.anacredit import check_conformance, conformance_share, map_tape
from polderbook.operators.kpis import row_count
from polderbook.operators.rules import (
    DIMENSIONS, RULES, SEVERITIES, rule_counts, rule_positions, run_all_rules, scoped_loans,
)
from polderbook.operators.validation import TapePlan

TOP_PER_SEVERITY = 50
TOP_PER_DIMENSION = 25
_SALTS = 256


def _with_all_keys(counts: DataFrame, key: str, keys: tuple[str, ...]) -> DataFrame:
    """Sum ``finding_count`` per key, zero for keys without findings, in the order of ``keys``."""
    empty = counts.sparkSession.createDataFrame(
        [(k, 0) for k in keys], f"{key} string, finding_count long"
    )
    totals = counts.unionByName(empty).groupBy(key).agg(
        F.sum("finding_count").alias("finding_count")
    )
    place = F.array_position(F.lit(list(keys)), F.col(key))
    return totals.withColumn("position", place.cast("int")).orderBy("position").select(
        key, "finding_count"
    )


def count_findings(findings: DataFrame, by: str) -> DataFrame:
    """Findings per severity or BCBS 239 dimension of any findings table."""
    keys = {"severity": SEVERITIES, "bcbs239_dimension": DIMENSIONS}[by]
    counts = findings.groupBy(by).agg(F.count(F.lit(1)).alias("finding_count"))
    return _with_all_keys(counts, by, keys)


def _counts_by(tape: DataFrame, by: str, keys: tuple[str, ...], **scope) -> DataFrame:
    # Counted from the rule flags: no finding row is built or shuffled.
    counts = rule_counts(tape, **scope).select(by, F.col("failed_count").alias("finding_count"))
    return _with_all_keys(counts, by, keys)


def findings_by_severity(
    tape: DataFrame, reference_date: date | Column | None = None, gated: bool = True
) -> DataFrame:
    return _counts_by(tape, "severity", SEVERITIES, reference_date=reference_date, gated=gated)


def findings_by_dimension(
    tape: DataFrame, reference_date: date | Column | None = None, gated: bool = True
) -> DataFrame:
    return _counts_by(
        tape, "bcbs239_dimension", DIMENSIONS, reference_date=reference_date, gated=gated
    )


def _rule_position() -> Column:
    place = F
    for name, i in rule_positions().items():
        place = place.when(F.col("rule_name") == name, F.lit(i))
    return place


def top_findings(
    tape: DataFrame, by: str, limit: int, reference_date: date | Column | None = None,
    gated: bool = True,
) -> DataFrame:
    """First ``limit`` findings per severity or dimension by loan and rule order, with group totals.

    A group may hold most of the findings, so the ranking runs twice: within 256
    slices of each group (each task already keeps only ``limit`` rows per slice)
    and then over the survivors. No task sorts a whole group.
    """
    found = run_all_rules(tape, reference_date, gated).withColumn("rule_position", _rule_position())
    order = ("loan_id", "rule_position")
    salted = found.withColumn("slice", F.pmod(F.hash("loan_id"), F.lit(_SALTS)))
    in_slice = Window.partitionBy(by, "slice").orderBy(*order)
    in_group = Window.partitionBy(by).orderBy(*order)
    ranked = (
        salted.withColumn("n", F.row_number().over(in_slice))
        .where(F.col("n") <= limit)
        .withColumn("rank", F.row_number().over(in_group))
        .where(F.col("rank") <= limit)
        .drop("n", "slice", "rule_position")
    )
    totals = _counts_by(
        tape, by, SEVERITIES if by == "severity" else DIMENSIONS,
        reference_date=reference_date, gated=gated,
    )
    # At most one row per severity or dimension.
    return ranked.join(F.broadcast(totals), by).withColumn(
        "truncated", F.col("finding_count") > limit
    )


def report_header(
    tape: DataFrame, tape_id: str, reference_date: date | Column | None = None
) -> DataFrame:
    """One row: tape, reference date, rows, validated loans and AnaCredit conformance in percent."""
    result = conformance_share(check_conformance(map_tape(tape, on_invalid="skip")))
    return result.select(
        F.lit(tape_id).alias("tape_id"),
        as_date(reference_date).alias("reference_date"),
        row_count(tape).alias("total_loans"),
        F.col("loan_count").alias("validated_loans"),
        F.round(F.col("conformance_share") * 100, 2).alias("conformance_pct"),
    )


# ---- fixed values: seeded cohorts and the rule each should trigger ------------
COHORT_RULES = {
    "NHG_CAP_BREACH_BATCH": "nhg_cap",
    "HIGH_INTEREST_ONLY_CLUSTER": "interest_only_cap",
    "STALE_TAXATIE_CLUSTER": "taxatie_freshness",
}


def _in_scope() -> Column:
    """Whether the target rule looks at the labelled loan at all."""
    label = F.col("easter_egg")
    return (
        F.when(label == "HIGH_INTEREST_ONLY_CLUSTER", F.col("tax_deduction_eligible"))
        .when(label == "STALE_TAXATIE_CLUSTER", F.col("ifrs9_stage") == "1")
        .otherwise(F.lit(True))
    )


def cohort_recall(tape: DataFrame, reference_date: date | Column | None = None) -> DataFrame:
    """Per labelled cohort: loans seeded, valid, in scope of the target rule and caught.

    Label and rule outcome sit on the same row, so this is one aggregate over the
    flags and needs no join with the findings.
    """
    plan = TapePlan(tape)
    labelled = tape.where(F.col("easter_egg").isin(*COHORT_RULES)).select(
        *plan.selection(), plan.row_ok.alias("is_valid")
    )
    _, context = scoped_loans(tape, reference_date, gated=False)
    target = F
    caught = F
    for label, name in COHORT_RULES.items():
        here = F.col("easter_egg") == label
        target = target.when(here, F.lit(name))
        caught = caught.when(here, RULES[name].failed(context))
    valid = F.col("is_valid")
    flagged = labelled.select(
        F.col("easter_egg").alias("cohort"),
        target.alias("rule_name"),
        valid.alias("v"),
        (valid & _in_scope()).alias("s"),
        (valid & caught).alias("c"),
    )
    return (
        flagged.groupBy("cohort", "rule_name")
        .agg(
            F.count(F.lit(1)).alias("seeded"),
            F.count_if("v").alias("seeded_valid"),
            F.count_if("s").alias("in_scope"),
            F.count_if("c").alias("caught"),
        )
        .withColumn("recall", F.try_divide("caught", "seeded_valid"))
        .withColumn("recall_in_scope", F.try_divide("caught", "in_scope"))
    )

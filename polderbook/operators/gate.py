"""Stage gates of a tape run and the ledger that records them."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from polderbook.functions.derived import as_date
from polderbook.operators import isolation, stress
from polderbook.operators.anacredit import REQUIRED_ATTRIBUTES, attribute_expressions, check_conformance, map_tape
from polderbook.operators.kpis import quick_scan_kpis, scan_indicators
from polderbook.operators.rules import RULES, RuleContext, scoped_loans
from polderbook.operators.validation import first_issues, validity_counts, with_validity

# ---- fixed value: share of loans with a critical finding that blocks a run -----
MAX_CRITICAL_SHARE = 0.01

# ---- fixed values: what a finding of each severity does to a run ---------------
SEVERITY_ACTIONS = {
    "CRITICAL": "FAILED",
    "HIGH": "WARNING",
    "MEDIUM": "REPORT",
    "LOW": "APPENDIX",
}


LEDGER = (
    "tape_id string, stage string, status string, checked_count bigint, flagged_count bigint, reference_date date, "
    "recorded_at timestamp, error_payload string, run_id string"
)


def severity_action(severity: Column) -> Column:
    action = F
    for name, result in SEVERITY_ACTIONS.items():
        action = action.when(severity == name, F.lit(result))
    return action


def _line(stage: str, checked: Column, flagged: Column, bad: Column, status: str) -> list[Column]:
    return [
        F.lit(stage).alias("stage"),
        F.when(bad, F.lit(status)).otherwise(F.lit("OK")).alias("status"),
        checked.cast("long").alias("checked_count"),
        flagged.cast("long").alias("flagged_count"),
    ]


def ingest_gate(tape: DataFrame) -> DataFrame:
    """FAILED when any row violates the schema."""
    skipped = F.col("skipped_count")
    return validity_counts(tape).select(
        *_line("ingest", F.col("row_count"), skipped, skipped > 0, "FAILED")
    )


def validation_gate(
    tape: DataFrame, reference_date: date | Column | None = None, gated: bool = True
) -> DataFrame:
    """BLOCKED when more than one percent of the loans have a critical finding."""
    rows, context = scoped_loans(tape, reference_date, gated)
    critical = reduce(or_, [r.failed(context) for r in RULES.values() if r.severity == "CRITICAL"])
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(critical).alias("hit"))
    return counts.select(
        *_line("validation", F.col("n"), F.col("hit"),
               F.col("hit") > F.col("n") * MAX_CRITICAL_SHARE, "BLOCKED")
    )


def anacredit_gate(tape: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """WARNING when a required attribute is empty."""
    checked = check_conformance(
        map_tape(tape, on_invalid="skip") if attributes is None else attributes
    )
    counts = checked.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("populated")).alias("hit"))
    return counts.select(
        *_line("anacredit", F.col("n"), F.col("hit"), F.col("hit") > 0, "WARNING")
    )


def quick_scan_gate(tape: DataFrame) -> DataFrame:
    """FAILED when an indicator is not a finite number."""
    kpis = quick_scan_kpis(tape)
    values = [F.col(f.name) for f in kpis.schema.fields if f.dataType.typeName() == "double"]
    infinite = F.lit(float("inf"))
    odd = [v.isNull() | F.isnan(v) | (F.abs(v) == infinite) for v in values]
    hits = reduce(lambda a, b: a + b, [o.cast("int") for o in odd])
    return kpis.select(*_line("quick_scan", F.lit(len(values)), hits, hits > 0, "FAILED"))


def stage_gates(tape: DataFrame, reference_date: date | Column | None = None) -> DataFrame:
    """One row per stage: status, rows (or indicators) checked and flagged."""
    return (
        ingest_gate(tape)
        .unionByName(validation_gate(tape, reference_date))
        .unionByName(anacredit_gate(tape))
        .unionByName(quick_scan_gate(tape))
    )


def write_with_gates(
    tape: DataFrame, path: str, reference_date: date | Column | None = None,
    scenario: Callable[[DataFrame], DataFrame] | None = None, sanity_bound: float = float("inf"),
    forest: isolation.Forest | None = None,
) -> DataFrame:
    """Write the typed tape to ``path`` and return its stage gates, counted while it is written.

    The tape is read once: validity, rules, required attributes, indicators, the ``scenario``
    (a function of ``operators.stress``) and the scores of a ``forest`` fitted before are
    columns of the same map, observed and not written. The write has no shuffle, so each task's
    counts enter once, whatever is retried. Rows as in ``stage_gates``, then ``stress`` (loans,
    loans without a finite loss; FAILED on one of those or on a change beyond three times
    ``sanity_bound``; only with a scenario) and ``anomaly`` (loans, listed loans; DEGRADED with
    a null count when there is no forest).
    """
    rows = with_validity(tape, "__valid")
    context = RuleContext(as_date(reference_date))
    critical = reduce(or_, [r.failed(context) for r in RULES.values() if r.severity == "CRITICAL"])
    attributes = F.struct(*attribute_expressions())
    empty = reduce(or_, [
        attributes[name].isNull() | (attributes[name].cast("string") == "") for name in REQUIRED_ATTRIBUTES])
    valid = F.col("__valid")
    added = {"__critical": valid & critical, "__empty": valid & empty}
    if forest is not None:
        added["__odd"] = isolation.score_column(forest) >= isolation.THRESHOLD
    watched = rows.withColumns(added)
    counts = [
        F.count(F.lit(1)).alias("rows"), F.count_if(valid).alias("valid"), F.count_if("__critical").alias("critical"),
        F.count_if("__empty").alias("empty"),
    ]
    indicators = scan_indicators(rows.drop("__valid").columns)
    counts += [value.alias(name) for name, value in indicators.items()]
    if forest is not None:
        counts.append(F.count_if("__odd").alias("odd"))
    if scenario is not None:
        watched = scenario(watched)
        counts += [
            F.coalesce(F.sum(F.col("stressed_el") - F.col("base_el")), F.lit(0.0)).alias("el_delta"),
            F.count_if(~stress.is_finite(F.col("stressed_el"))).alias("non_finite"),
        ]
    seen = Observation()
    watched.observe(seen, *counts).select(*[c for c in rows.columns if c != "__valid"]).write.parquet(path)
    found = seen.get
    skipped, odd_values = found["rows"] - found["valid"], sum(not _is_finite(found[name]) for name in indicators)
    lines = [
        ("ingest", "FAILED" if skipped else "OK", found["rows"], skipped),
        ("validation", "BLOCKED" if found["critical"] > found["valid"] * MAX_CRITICAL_SHARE else "OK",
         found["valid"], found["critical"]),
        ("anacredit", "WARNING" if found["empty"] else "OK", found["valid"], found["empty"]),
        ("quick_scan", "FAILED" if odd_values else "OK", len(indicators), odd_values),
    ]
    if scenario is not None:
        out_of_band = not abs(found["el_delta"]) <= 3 * sanity_bound
        lines.append(("stress", "FAILED" if found["non_finite"] or out_of_band else "OK", found["rows"], found["non_finite"]))
    lines.append(("anomaly", "OK" if forest else "DEGRADED", found["rows"], found["odd"] if forest else None))
    return tape.sparkSession.createDataFrame(lines, "stage string, status string, checked_count bigint, flagged_count bigint")


def _is_finite(value: float | None) -> bool:
    return value is not None and math.isfinite(value)


def ledger_rows(
    gates: DataFrame, run_id: str, tape_id: str, reference_date: date | Column | None = None
) -> DataFrame:
    return gates.select(
        F.lit(run_id).alias("run_id"),
        F.lit(tape_id).alias("tape_id"),
        "stage", "status", "checked_count", "flagged_count",
        as_date(reference_date).alias("reference_date"),
        F.current_timestamp().alias("recorded_at"),
    )


#: Violations that a ledger row quotes.
PAYLOAD_ROWS = 10


def error_payload(tape: DataFrame, max_issues: int = PAYLOAD_ROWS) -> DataFrame:
    """One row with ``error_payload``: the first violations as JSON, in order of ``loan_id``; null without any."""
    found = first_issues(tape, ["loan_id"], max_issues).select("loan_id", "field", "code")
    ordered = F.sort_array(F.collect_list(F.struct("loan_id", "field", "code")))
    return found.agg(F.when(F.count(F.lit(1)) > 0, F.to_json(ordered, {"ignoreNullFields": "false"})).alias("error_payload"))


def with_payload(ledger: DataFrame, payload: DataFrame) -> DataFrame:
    """Ledger rows with the payload on the ingest row of a run that did not pass; ``payload`` has one row."""
    shown = F.when((F.col("stage") == "ingest") & (F.col("status") != "OK"), F.col("error_payload"))
    return ledger.join(payload.select(F.lit("ingest").alias("__stage"), "error_payload"), F.col("stage") == F.col("__stage"), "left"
                       ).select(*ledger.columns, shown.alias("error_payload"))


def append_to_ledger(
    gates: DataFrame, path: str, run_id: str, tape_id: str,
    reference_date: date | Column | None = None, payload: DataFrame | None = None,
) -> None:
    """Record the outcome of a run: a handful of rows in the partition of its ``run_id``.

    Only the partition written is replaced, so a run that is recorded again after a failure
    has one set of rows, and other runs may be recorded at the same time.
    """
    rows = ledger_rows(gates, run_id, tape_id, reference_date)
    rows = with_payload(rows, payload) if payload is not None else rows.withColumn(
        "error_payload", F.lit(None).cast("string"))
    rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All recorded runs."""
    return spark.read.schema(LEDGER).parquet(path)

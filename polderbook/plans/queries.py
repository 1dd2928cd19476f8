"""Every operator as a named query over the test tables.

Doubles from sums are rounded here (not in the operators), because two engines
add in different orders.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from polderbook.functions import derived
from polderbook.functions.lookups import hra_rate_for, nhg_cap_for, nibud_columns
from polderbook.model import FIELDS
from polderbook.operators import (
    anacredit, anomaly, asof, bridge, difference, drift, gate, history, isolation, kpis, portfolio, profile, report, rules, sicr,
    stress, transitions, validation,
)
from polderbook.plans import source_queries
from polderbook.plans.tape_view import derive_tape, next_tape_view, tape_view
from polderbook.session import tune
from polderbook.sources import reader, store
from polderbook.sources.shared import working_folder

REFERENCE_DATE = date(2025, 6, 1)
LTV_EDGES = (0.5, 0.7, 0.9, 1.0)
HOUSE_PRICE_SHOCK = -0.2
ENERGY_DISCOUNTS = {"E": 0.05, "F": 0.10, "G": 0.15}
#: Every numeric column of the tape.
NUMERIC = tuple(f.name for f in FIELDS if f.kind in ("int", "double"))

Query = Callable[[SparkSession, str], DataFrame]


def rounded(frame: DataFrame, **digits: int) -> DataFrame:
    return frame.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _finding_keys(findings: DataFrame) -> DataFrame:
    return findings.select("loan_id", "rule_name", "severity", "bcbs239_dimension", "passed")


def _tampered(tape: DataFrame) -> DataFrame:
    """Conformance of attributes with a wrong currency and a missing amount on some contracts."""
    number = F.substring("contract_identifier", 4, 9).cast("long")
    mapped = anacredit.map_tape(tape, on_invalid="skip").withColumns({
        "currency": F.when(number % 10 == 0, F.lit("XYZ")).otherwise(F.col("currency")),
        "outstanding_nominal_amount": F.when(number % 7 != 0, F.col("outstanding_nominal_amount")),
    })
    return anacredit.check_conformance(mapped).withColumns({
        "missing_attributes": F.array_join("missing_attributes", ","),
        "invalid_values": F.array_join("invalid_values", ","),
    })


def _with_origination_pd(tape: DataFrame) -> DataFrame:
    """The tape plus the optional lifetime PD at origination that one trigger needs."""
    return tape.withColumn(sicr.ORIGINATION_PD, F.col("pd_12m") * 1.5)


def _exposures(frame: DataFrame) -> DataFrame:
    digits = {"exposure": 2}
    if "exposure_share" in frame.columns:
        digits["exposure_share"] = 6
    return rounded(frame, **digits)


def _steps(stressed: DataFrame) -> DataFrame:
    return rounded(stress.stress_summary(stressed), base_el=2, stressed_el=2, el_delta=2)


_SCAN_DIGITS = {
    "total_exposure": 2, "weighted_avg_pd_12m": 8, "weighted_avg_pd_lifetime": 8,
    "weighted_avg_current_ltv": 4, "weighted_avg_hra_phase_out_rate": 8, "nhg_share": 8,
    "aflossingsvrij_share": 8, "weighted_avg_current_ltv_safe": 8,
}

R = REFERENCE_DATE

# Queries over the tape alone.
_ON_TAPE: dict[str, Callable[[DataFrame], DataFrame]] = {
    # quick scan and derived measures
    "quick_scan_kpis": lambda t: rounded(kpis.quick_scan_kpis(t), **_SCAN_DIGITS),
    "stage_mix": lambda t: rounded(kpis.stage_mix(t), share=8),
    "energy_label_mix": lambda t: rounded(kpis.energy_label_mix(t), share=8),
    "vintage_histogram": kpis.vintage_histogram,
    "derived_fields": lambda t: derived.with_derived_fields(t).select(
        "loan_id", "current_ltv", "original_lti", "expected_loss"
    ),
    "valuation_age": lambda t: t.select(
        "loan_id",
        derived.calendar_months(F.col("taxatie_date"), derived.as_date(R)).alias("months"),
    ),
    # schema validation
    "schema_valid_flag": lambda t: validation.with_validity(t).select("loan_id", "is_valid"),
    "schema_violations": lambda t: validation.schema_violations(t).select(
        "loan_id", "field", "code"
    ),
    "first_issues": lambda t: validation.first_issues(t, ["loan_id"]).select(
        "loan_id", "field", "code"
    ),
    "valid_count": validation.validity_counts,
    # rules
    "rule_failures": lambda t: _finding_keys(rules.run_all_rules(t, R)),
    "rule_failures_raw": lambda t: _finding_keys(rules.run_all_rules(t, R, gated=False)),
    "rule_counts": lambda t: rules.rule_counts(t, R),
    "rule_counts_raw": lambda t: rules.rule_counts(t, R, gated=False),
    "findings_critical": lambda t: rules.findings_at(rules.run_all_rules(t, R), "CRITICAL").select(
        "loan_id", "rule_name"
    ),
    "flagged_loans": lambda t: rules.flagged_loans(
        t.select("loan_id", "original_principal", "nhg_cap_at_origination"),
        rules.run_all_rules(t, R), "nhg_cap",
    ),
    # AnaCredit
    "anacredit_map": lambda t: anacredit.map_tape(t, on_invalid="skip"),
    "anacredit_conformance": anacredit.portfolio_conformance,
    "anacredit_tampered": _tampered,
    "anacredit_extra": lambda t: anacredit.map_tape_extended(t, R),
    "counterparty_default": anacredit.counterparty_default_status,
    # report
    "findings_by_severity": lambda t: report.findings_by_severity(t, R),
    "findings_by_dimension": lambda t: report.findings_by_dimension(t, R),
    "top_findings_severity": lambda t: report.top_findings(
        t, "severity", report.TOP_PER_SEVERITY, R
    ).select("severity", "loan_id", "rule_name", "rank", "finding_count", "truncated"),
    "top_findings_dimension": lambda t: report.top_findings(
        t, "bcbs239_dimension", report.TOP_PER_DIMENSION, R
    ).select("bcbs239_dimension", "loan_id", "rule_name", "rank", "finding_count", "truncated"),
    "report_header": lambda t: report.report_header(t, "driver", R),
    "cohort_recall": lambda t: rounded(
        report.cohort_recall(t, R), recall=8, recall_in_scope=8
    ),
    # store filters, lookups and profiles
    "query_by_vintage": lambda t: store.by_vintage(
        t, date(2015, 1, 1), date(2018, 12, 31)
    ).select("loan_id", "origination_date", "current_balance"),
    "query_by_stage": lambda t: store.by_stage(t, "2").select(
        "loan_id", "ifrs9_stage", "current_balance"
    ),
    # Three years early, so that some loans fall before the first published year.
    "nhg_cap_lookup": lambda t: t.select(
        "loan_id", nhg_cap_for(derived.vintage() - 3).alias("nhg_cap")
    ),
    "hra_rate_lookup": lambda t: t.select(
        "loan_id", hra_rate_for(derived.vintage()).alias("hra_rate")
    ),
    "nhg_cap_published": lambda t: t.select(
        "loan_id", "nhg_cap_at_origination", nhg_cap_for(derived.vintage()).alias("published_cap")
    ).where(F.col("nhg_cap_at_origination") != F.col("published_cap")),
    "nibud_lti": lambda t: t.withColumns(nibud_columns())
    .select("loan_id", "original_lti", "nibud_factor", "exceeds_nibud", F.col("nibud_factor").isNotNull().alias("assessed")),
    "profile_shares": lambda t: rounded(
        profile.share_profile(t), annuity_share_post_2013=8, legacy_share_pre_2013=8,
        low_label_share_old_stock=8, high_label_share_new_stock=8, reset_wave_share=8,
    ),
    "profile_assertions": profile.assertion_profile,
    # portfolio
    "vintage_arrears": lambda t: rounded(
        portfolio.vintage_arrears(t), exposure=2, share_of_vintage=8
    ),
    "vintage_arrears_matrix": portfolio.vintage_arrears_matrix,
    "concentration_pc4": lambda t: _exposures(portfolio.concentration_pc4(t)),
    "concentration_gemeente": lambda t: _exposures(portfolio.concentration_gemeente(t, top=5)),
    "borrower_top": lambda t: _exposures(portfolio.borrower_concentration(t, top=20)),
    "ltv_bands": lambda t: _exposures(portfolio.ltv_bands(t, LTV_EDGES)),
    "rentevast_waterfall": lambda t: _exposures(portfolio.rentevast_waterfall(t)),
    "energy_by_age": lambda t: _exposures(portfolio.energy_by_age(t)),
    "rwa_density": lambda t: rounded(portfolio.rwa_density(t), rwa=2, ead=2, rwa_density=8),
    "ecl_by_stage": lambda t: rounded(portfolio.ecl_by_stage(t), ead=2, ecl=2, coverage=8),
    "vintage_trend": lambda t: rounded(
        portfolio.vintage_trend(t), exposure=2, weighted_pd_12m=8, weighted_ltv=8, nhg_share=8,
        pd_change=8, ltv_change=8,
    ),
    # significant increase in credit risk
    "sicr_triggers": lambda t: sicr.sicr_triggers(_with_origination_pd(t), R).selectExpr(
        "loan_id", *[f"sicr_{n}" for n in (
            "quant_pd_increase", "dpd_30_backstop", "forbearance", "watchlist", "macro_overlay",
            "climate_transition", "reasons",
        )], "derived_stage",
    ),
    "sicr_trigger_counts": lambda t: sicr.trigger_counts(_with_origination_pd(t), R),
    "stage_transition": lambda t: _exposures(sicr.stage_transitions(_with_origination_pd(t), R)),
    "sicr_quality": lambda t: rounded(
        sicr.trigger_quality(_with_origination_pd(t), F.col("sicr_trigger_reason") != "NONE", R),
        recall=8, specificity=8,
    ),
    # stress
    "stress_house_price": lambda t: _steps(stress.house_price_shock(t, HOUSE_PRICE_SHOCK)),
    "stress_energy": lambda t: _steps(stress.energy_transition(t, ENERGY_DISCOUNTS)),
    "stress_hra": lambda t: _steps(stress.hra_phase_out(t, new_rate=0.25, pd_response=5.0)),
    "stress_rate_reset": lambda t: _steps(
        stress.rate_reset(t, *profile.RESET_WINDOW, pd_response=5.0)
    ),
    "stress_check": lambda t: rounded(
        stress.stress_check(stress.house_price_shock(t, HOUSE_PRICE_SHOCK), sanity_bound=1e7),
        base_el=2, stressed_el=2, el_delta=2,
    ).drop("waterfall_gap"),
    # anomalies
    "anomaly_rules": lambda t: rounded(
        anomaly.robust_outliers(t, "repayment_type", NUMERIC, threshold=2.0), max_abs_z=6
    ),
    "anomaly_forest": lambda t: rounded(isolation.score(t, isolation.fit(t, NUMERIC)), score=8),
    "repayment_mix_anomaly": lambda t: rounded(
        anomaly.repayment_mix_anomaly(t), share=8, mean_others=8, sd_others=8, z_score=5
    ),
    # gates
    "stage_gate": lambda t: gate.stage_gates(t, R),
    "run_ledger": lambda t: gate.ledger_rows(gate.stage_gates(t, R), "run-1", "driver", R).drop(
        "recorded_at"
    ),
}
_ON_TAPE |= {
    f"rule_{name}": lambda t, name=name: _finding_keys(
        rules.run_rule(t, name, R, include_passes=True)
    )
    for name in list(rules.RULES)
}

# Queries over two snapshots.
_ON_TWO_TAPES: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "roll_rate": lambda t, n: rounded(transitions.roll_rates(t, n), exposure=2, roll_rate=8),
    "ks_drift": lambda t, n: rounded(
        drift.ks_drift(t, n, NUMERIC), ks_statistic=8, p_value=6
    ),
}


def _number() -> Column:
    return F.substring("loan_id", 4, 9).cast("long")


def _income_bands(tape: DataFrame) -> DataFrame:
    """Each loan with the factor of its income band; bands start at the incomes of every third loan of a year."""
    loans = tape.select("loan_id", derived.vintage().alias("year"), F.col("gross_household_income").alias("income"))
    bands = loans.where(_number() % 3 == 0).select(
        "year", "income", (F.floor(F.col("income") / 1000) % 7 + 3).cast("double").alias("factor"))
    return asof.asof_join(loans, bands, ["year"], "income", ["factor"], before_first="first")


def _csv_values(tape: DataFrame) -> DataFrame:
    """The tape written as CSV with line breaks and quotes in a remark, and read back."""
    path = f"{working_folder(tape.sparkSession, 'csv')}/tape.csv"
    remark = F.when(_number() % 3 == 0, F.concat(F.lit('first "line"\n'), "loan_id", F.lit(",\n\nlast"))).otherwise(F.col("gemeente"))
    reader.payload(tape).withColumn("remark", remark).write.option("header", True).option("escape", '"').csv(path)
    return reader.load_tape(tape.sparkSession, path).tape


def _store_versions(tape: DataFrame) -> DataFrame:
    """A reader opened before an overwrite, and the version that replaced it."""
    shelf = store.TapeStore(tape.sparkSession, working_folder(tape.sparkSession, "store"))
    first = shelf.write_tape(reader.payload(tape), "tape")
    opened = shelf.read_tape("tape")
    second = shelf.write_tape(store.by_stage(opened, "2"), "tape", after=first)
    versions = ((opened, first), (shelf.read_tape("tape"), second), (shelf.query_by_stage("tape", "1"), second))
    read = [t.select("loan_id", "ifrs9_stage", "current_balance", F.lit(v).cast("bigint").alias("version")) for t, v in versions]
    return read[0].unionByName(read[1]).unionByName(read[2])


def _snapshots(tape: DataFrame) -> DataFrame:
    """Four yearly snapshots of the loans; loans enter late, and their risk and status move."""
    def snapshot(year: int) -> DataFrame:
        turn = (_number() * 7 + year * 3) % 11
        return tape.where(_number() % 4 <= year - 2022).select(
            "loan_id", F.lit(date(year, 6, 1)).alias("snapshot_date"),
            (F.col("pd_lifetime") * (0.25 + (_number() + year) % 5)).alias("pd_lifetime"),
            (turn >= 7).alias("restructured_flag"), F.when(turn == 3, F.lit(120)).otherwise(F.col("days_past_due")).alias("days_past_due"),
            "unlikely_to_pay_flag", F.when(turn == 3, F.lit("3")).otherwise(F.lit("1")).alias("ifrs9_stage"))

    frames = [snapshot(y) for y in (2022, 2023, 2024, 2025)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


def _origination_pd(tape: DataFrame) -> DataFrame:
    """The quantitative trigger against the first snapshot; the last snapshot is merged into an earlier result."""
    past = _snapshots(tape)
    cut = F.lit(date(2025, 1, 1))
    known = history.first_values(past.where(F.col("snapshot_date") < cut), ["pd_lifetime"])
    first = history.first_values(past.where(F.col("snapshot_date") >= cut), ["pd_lifetime"], known=known)
    return sicr.sicr_triggers(history.with_origination_pd(tape, first), R).select(
        "loan_id", sicr.ORIGINATION_PD, "sicr_quant_pd_increase")


def _changed_tape(tape: DataFrame, later: DataFrame) -> DataFrame:
    """Differences to the next snapshot, in which some loans are gone, new or listed twice."""
    after = later.where(_number() % 97 != 0)
    twice = after.where(_number() % 89 == 0)
    fresh = tape.where(_number() % 101 == 0).withColumn("loan_id", F.concat("loan_id", F.lit("-N")))
    return difference.tape_difference(tape, after.unionByName(twice).unionByName(fresh))


def _shocks() -> dict[str, bridge.Shock]:
    """House prices, energy discounts, a lower deduction and the rate reset, in this order."""
    discount = F
    for label, size in ENERGY_DISCOUNTS.items():
        discount = discount.when(F.col("energy_label") == label, F.lit(1.0 - size))
    lost = F.greatest(F.lit(0.0), F.col("hra_phase_out_rate") - 0.25)
    balance, resets = F.col("current_balance"), F.col("rentevast_einddatum").between(*map(F.lit, profile.RESET_WINDOW))
    return {
        "house_price": bridge.Shock(value_factor=F.lit(1.0 + HOUSE_PRICE_SHOCK)),
        "energy": bridge.Shock(value_factor=discount.otherwise(F.lit(1.0))),
        "deduction": bridge.Shock(yearly_cost=F.when(
            F.col("tax_deduction_eligible"), balance * F.col("interest_rate") * lost).otherwise(F.lit(0.0)), pd_response=5.0),
        "rate_reset": bridge.Shock(yearly_cost=F.when(resets, balance * 0.02).otherwise(F.lit(0.0)), pd_response=5.0),
    }


def _bridge(tape: DataFrame) -> DataFrame:
    steps = bridge.loss_bridge(tape, _shocks(), sanity_bound=1e9)
    return steps.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in ("amount", "cumulative", "gap")})


def _broken_bridge(tape: DataFrame) -> DataFrame:
    """A tape that fails: some loans have no LGD."""
    return _bridge(tape.withColumn("lgd", F.when(_number() % 50 != 0, F.col("lgd"))))


def _shocked(tape: DataFrame) -> DataFrame:
    return stress.house_price_shock(tape, HOUSE_PRICE_SHOCK)


def _observed(tape: DataFrame) -> DataFrame:
    """Gates counted while the tape is written; the forest is grown on the tape before."""
    return gate.write_with_gates(
        tape, working_folder(tape.sparkSession, "gated"), R, _shocked, 1e7, isolation.fit(tape, NUMERIC))


def _failing_gates(tape: DataFrame) -> DataFrame:
    """A tape on which the gates close: impossible risk figures and breached caps on some loans."""
    broken, capped = _number() % 50 == 0, _number() % 20 == 1
    odd = F.lit(float("nan"))
    changed = tape.withColumns({
        "lgd": F.when(broken, F.lit(1.5)).otherwise(F.col("lgd")),
        "pd_12m": F.when(broken, odd).otherwise(F.col("pd_12m")), "pd_lifetime": F.when(broken, odd).otherwise(F.col("pd_lifetime")),
        "nhg_flag": F.when(capped, F.lit(True)).otherwise(F.col("nhg_flag")),
        "nhg_cap_at_origination": F.when(capped, F.lit(1.0)).otherwise(F.col("nhg_cap_at_origination")),
        "borrower_id": F.when(_number() % 30 == 2, F.lit(" ")).otherwise(F.col("borrower_id")),
    })
    return gate.write_with_gates(changed, working_folder(tape.sparkSession, "gated"), R, _shocked, 1e7)


def _recorded(tape: DataFrame) -> DataFrame:
    """A ledger in which one run was recorded twice, as after a retry."""
    path = working_folder(tape.sparkSession, "ledger")
    gates, payload = gate.stage_gates(tape, R), gate.error_payload(tape)
    for run in ("run-1", "run-2", "run-1"):
        gate.append_to_ledger(gates, path, run, "driver", R, payload)
    return gate.read_ledger(tape.sparkSession, path).drop("recorded_at")


_ON_TAPE |= {
    "income_bands_asof": _income_bands,
    "load_csv_values": lambda t: _csv_values(t).select(
        "loan_id", "origination_date", "current_balance", "bouwjaar", "tax_deduction_eligible", "rentevast_einddatum", "remark"),
    "store_versions": _store_versions,
    "origination_pd": _origination_pd,
    "credit_events": lambda t: history.credit_events(_snapshots(t), F.lit(R)),
    "ledger_after_retry": _recorded,
    "gates_observed": _observed,
    "gates_failing": _failing_gates,
    "loss_bridge": _bridge,
    "loss_bridge_failing": _broken_bridge,
}
_ON_TAPE |= source_queries.QUERIES
_ON_TWO_TAPES["tape_difference"] = _changed_tape


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {"tape_view": lambda spark, sf: derive_tape(tune(spark), sf)}
    for name, build in _ON_TAPE.items():
        found[name] = lambda spark, sf, build=build: build(tape_view(tune(spark), sf))
    for name, build in _ON_TWO_TAPES.items():
        found[name] = lambda spark, sf, build=build: build(
            tape_view(tune(spark), sf), next_tape_view(spark, sf)
        )
    return found

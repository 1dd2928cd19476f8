from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from polderbook.operators import gate, kpis, profile, report, rules
from tests.rows import REFERENCE_DATE, cases, loan, tape


def test_quick_scan_values(spark):
    frame = cases(
        spark,
        {"borrower_id": "A", "current_balance": 100.0, "pd_12m": 0.1, "nhg_flag": True},
        {"borrower_id": "A", "current_balance": 300.0, "pd_12m": 0.2, "ifrs9_stage": "2",
         "repayment_type": "AFLOSSINGSVRIJ"},
        {"borrower_id": None, "current_balance": 0.0, "energy_label": "G"},
        {"borrower_id": "B", "current_balance": 100.0, "pd_12m": None},
    )
    out = kpis.quick_scan(frame)
    assert out["loan_count"] == 4 and out["borrower_count"] == 3  # null counts as a borrower
    assert out["total_exposure"] == 500.0
    assert out["weighted_avg_pd_12m"] == pytest.approx((10 + 60) / 500)  # null keeps its weight
    assert out["nhg_share"] == 0.25 and out["aflossingsvrij_share"] == 0.25
    assert out["ifrs9_stage_mix"] == {"1": 0.75, "2": 0.25, "3": 0.0}
    assert out["energy_label_mix"] == {"C": 0.75, "G": 0.25}


def test_ltv_of_a_zero_valuation(spark):
    frame = cases(spark, {"current_balance": 100.0, "property_value_current": 0.0})
    row = kpis.quick_scan_kpis(frame).first()
    assert row["weighted_avg_current_ltv"] == 100.0
    assert row["weighted_avg_current_ltv_safe"] == 0.0
    stored = kpis.quick_scan_kpis(frame.withColumn("current_ltv", F.lit(0.7))).first()
    assert stored["weighted_avg_current_ltv"] == pytest.approx(0.7)


def test_zero_weight_and_empty_tape(spark):
    zero = kpis.quick_scan(cases(spark, {"current_balance": 0.0}))
    assert zero["weighted_avg_pd_12m"] == 0.0 and zero["loan_count"] == 1
    empty = kpis.quick_scan(tape(spark, loan()).limit(0))
    assert empty["ifrs9_stage_mix"] == {"1": 0.0, "2": 0.0, "3": 0.0}
    assert empty["energy_label_mix"] == {}
    assert {v for k, v in empty.items() if not k.endswith("_mix")} == {0}
    assert kpis.vintage_histogram(tape(spark, loan()).limit(0)).count() == 0


def test_vintages_are_ascending(spark):
    frame = cases(spark, *[{"origination_date": date(y, 3, 1)} for y in (2020, 2014, 2020)])
    assert [tuple(r) for r in kpis.vintage_histogram(frame).collect()] == [(2014, 1), (2020, 2)]


def many_findings(spark):
    """130 stale valuations, three critical loans, one of them with two findings."""
    stale = [{"taxatie_date": date(2018, 1, 1)}] * 130
    critical = [{"current_balance": 400000.0}] * 2 + [
        {"current_balance": 400000.0, "property_value_current": 0.0}]
    return cases(spark, *stale, *critical, {"lgd": 2.0})


def test_finding_counts_show_every_key(spark):
    frame = many_findings(spark)
    by_severity = [tuple(r) for r in report.findings_by_severity(frame, REFERENCE_DATE).collect()]
    assert by_severity == [("CRITICAL", 3), ("HIGH", 1), ("MEDIUM", 130), ("LOW", 0)]
    by_dim = [tuple(r) for r in report.findings_by_dimension(frame, REFERENCE_DATE).collect()]
    assert by_dim == [("accuracy", 1), ("completeness", 0), ("timeliness", 130), ("integrity", 3)]
    findings = rules.run_all_rules(frame, REFERENCE_DATE)
    for by, expected in (("severity", by_severity), ("bcbs239_dimension", by_dim)):
        assert [tuple(r) for r in report.count_findings(findings, by).collect()] == expected


def test_top_findings_are_the_first_of_each_group(spark):
    rows = report.top_findings(many_findings(spark), "severity", 50, REFERENCE_DATE).collect()
    medium = sorted((r["rank"], r["loan_id"]) for r in rows if r["severity"] == "MEDIUM")
    assert medium == [(i, f"LN-{i:07d}") for i in range(1, 51)]
    assert {(r["severity"], r["finding_count"], r["truncated"]) for r in rows} == {
        ("CRITICAL", 3, False), ("HIGH", 1, False), ("MEDIUM", 130, True)}


def test_header(spark):
    row = report.report_header(many_findings(spark), "t1", REFERENCE_DATE).first()
    assert (row["tape_id"], row["total_loans"], row["validated_loans"]) == ("t1", 134, 133)
    assert row["conformance_pct"] == 100.0 and row["reference_date"] == REFERENCE_DATE


def test_cohort_recall(spark):
    nhg = {"nhg_flag": True, "nhg_cap_at_origination": 1000.0}
    label = F.when(F.col("loan_id") <= "LN-0000002", "NHG_CAP_BREACH_BATCH").when(
        F.col("loan_id") <= "LN-0000004", "STALE_TAXATIE_CLUSTER")
    old = {"taxatie_date": date(2018, 1, 1)}
    frame = cases(spark, nhg, {**nhg, "lgd": 3.0}, old, {**old, "ifrs9_stage": "2"}, {})
    out = {r["cohort"]: r for r in report.cohort_recall(
        frame.withColumn("easter_egg", label), REFERENCE_DATE).collect()}
    a, b = out["NHG_CAP_BREACH_BATCH"], out["STALE_TAXATIE_CLUSTER"]
    assert (a["seeded"], a["seeded_valid"], a["in_scope"], a["caught"]) == (2, 1, 1, 1)
    assert (b["seeded"], b["in_scope"], b["caught"], b["recall"], b["recall_in_scope"]) == (
        2, 1, 1, 0.5, 1.0)


def test_profiles(spark):
    frame = cases(spark, {"bouwjaar": 2001, "rentevast_einddatum": date(2027, 1, 1)}, {"energy_label": "G", "bouwjaar": 1950},
                  {"pc6": "bad", "bouwjaar": 2001})
    shares = profile.share_profile(frame).first()
    assert shares["low_label_share_old_stock"] == 1.0
    assert shares["legacy_share_pre_2013"] is None
    assert shares["reset_wave_share"] == pytest.approx(1 / 3)
    checks = profile.assertion_profile(frame).first()
    assert checks["all_pc6_valid"] is False and checks["all_currency_eur"] is True
    assert checks["energy_label_count"] == 2


def statuses(frame):
    return {r["stage"]: (r["status"], r["checked_count"], r["flagged_count"])
            for r in gate.stage_gates(frame, REFERENCE_DATE).collect()}


def test_gates(spark):
    assert statuses(cases(spark, *[{}] * 3)) == {
        "ingest": ("OK", 3, 0), "validation": ("OK", 3, 0), "anacredit": ("OK", 3, 0),
        "quick_scan": ("OK", 8, 0)}
    critical = {"current_balance": 400000.0}
    assert statuses(cases(spark, critical, *[{}] * 99))["validation"] == ("OK", 100, 1)
    assert statuses(cases(spark, critical, *[{}] * 98))["validation"] == ("BLOCKED", 99, 1)
    assert statuses(cases(spark, {"lgd": 2.0}, {}))["ingest"] == ("FAILED", 2, 1)
    odd = statuses(cases(spark, {"pd_12m": float("nan")}, {}))
    assert odd["quick_scan"] == ("FAILED", 8, 1)


def test_anacredit_gate_warns(spark):
    from polderbook.operators.anacredit import map_tape

    frame = cases(spark, {})
    attributes = map_tape(frame).withColumn("currency", F.lit(None).cast("string"))
    assert gate.anacredit_gate(frame, attributes).first()["status"] == "WARNING"


def test_ledger_appends(spark, tmp_path):
    gates = gate.stage_gates(cases(spark, {}), REFERENCE_DATE)
    path = str(tmp_path / "ledger")
    gate.append_to_ledger(gates, path, "r1", "t", REFERENCE_DATE)
    gate.append_to_ledger(gates, path, "r2", "t", REFERENCE_DATE)
    ledger = spark.read.parquet(path)
    assert ledger.count() == 8 and ledger.select("run_id").distinct().count() == 2


def test_severity_actions(spark):
    frame = spark.createDataFrame([(s,) for s in rules.SEVERITIES], "s string")
    got = [r[0] for r in frame.select(gate.severity_action(F.col("s"))).collect()]
    assert got == ["FAILED", "WARNING", "REPORT", "APPENDIX"]

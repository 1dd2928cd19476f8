from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from polderbook.operators import rules
from tests.rows import LOAN, REFERENCE_DATE, cases

PRINCIPAL, INCOME, WORTH = LOAN["original_principal"], LOAN["gross_household_income"], LOAN["property_value_at_origination"]
#: Rule, a change just beyond its threshold, a change just within it.
CASES = [
    ("taxatie_freshness", {"taxatie_date": date(2022, 5, 31)}, {"taxatie_date": date(2022, 6, 1)}),
    ("lti_cap", {"gross_household_income": PRINCIPAL / 6.01}, {"gross_household_income": PRINCIPAL / 6}),
    ("negative_amortization", {"current_balance": PRINCIPAL * 1.0011}, {"current_balance": PRINCIPAL * 1.0009}),
    ("interest_only_cap", {"interest_only_portion": WORTH / 2 + 1}, {"interest_only_portion": WORTH / 2}),
    ("ltv_consistency", {"property_value_current": 0.0}, {"property_value_current": 1.0}),
    ("nhg_cap", {"nhg_flag": True, "nhg_cap_at_origination": PRINCIPAL - 1}, {"nhg_flag": True, "nhg_cap_at_origination": PRINCIPAL}),
]
RAW_CASES = [
    ("pd_monotonicity", {"pd_lifetime": LOAN["pd_12m"] / 2}, {"pd_lifetime": LOAN["pd_12m"]}),
    ("hra_eligibility", {"origination_date": date(2012, 12, 31)}, {"origination_date": date(2013, 1, 1)}),
    ("stage_3_backstop", {"ifrs9_stage": "3", "days_past_due": 89}, {"ifrs9_stage": "3", "days_past_due": 90}),
]


def failures(frame, **kw):
    out: dict[int, list[str]] = {}
    for r in rules.run_all_rules(frame, REFERENCE_DATE, **kw).collect():
        out.setdefault(int(r["loan_id"][3:]), []).append(r["rule_name"])
    return out


def test_registry_is_the_nine_rules_in_order():
    assert list(rules.RULES) == [
        "negative_amortization", "stage_3_backstop", "nhg_cap", "hra_eligibility",
        "ltv_consistency", "pd_monotonicity", "taxatie_freshness", "lti_cap", "interest_only_cap",
    ]


def test_each_rule_fails_and_passes(spark):
    bad = failures(cases(spark, *[c for _, c, _ in CASES]))
    assert bad == {i: [name] for i, (name, _, _) in enumerate(CASES, 1)}
    assert failures(cases(spark, *[c for _, _, c in CASES])) == {}


def test_rules_behind_the_schema_fire_only_ungated(spark):
    frame = cases(spark, *[c for _, c, _ in RAW_CASES])
    assert failures(frame) == {}
    assert failures(frame, gated=False) == {i: [n] for i, (n, _, _) in enumerate(RAW_CASES, 1)}
    assert failures(cases(spark, *[c for _, _, c in RAW_CASES]), gated=False) == {}


def test_findings_carry_the_rule_attributes(spark):
    row = rules.run_all_rules(cases(spark, {"current_balance": 400000.0}), REFERENCE_DATE).first()
    assert row.asDict() == {
        "loan_id": "LN-0000001", "rule_name": "negative_amortization", "severity": "CRITICAL",
        "regulation": "Schema integrity (internal)", "bcbs239_dimension": "integrity",
        "message": "balance 400,000 is more than 0.1% above the principal 240,000",
        "passed": False,
    }
    assert all(r.regulation for r in rules.RULES.values())


def test_messages(spark):
    frame = cases(spark, *[c for _, c, _ in CASES + RAW_CASES])
    text = {r["rule_name"]: r["message"]
            for r in rules.run_all_rules(frame, REFERENCE_DATE, gated=False).collect()}
    assert text["nhg_cap"] == "guaranteed under NHG, but the principal 240,000 is above the cap 239,999"
    assert text["taxatie_freshness"] == (
        "last valued on 2022-05-31, 37 months ago; stage 1 allows 36")
    assert text["lti_cap"] == (
        "borrowed 6.01 times the income, limit 6.0")
    assert text["interest_only_cap"] == (
        "interest-only part 140,001 is above its limit of 140,000")
    assert text["pd_monotonicity"] == "12-month PD 0.004 is above the lifetime PD 0.002"
    assert "LINEAIR" in text["hra_eligibility"] and "2012-12-31" in text["hra_eligibility"]


def test_invalid_rows_are_skipped_by_default(spark):
    frame = cases(spark, {"current_balance": 400000.0, "lgd": 2.0})
    assert failures(frame) == {}
    assert failures(frame, gated=False) == {1: ["negative_amortization"]}


def test_stored_ltv_is_compared_when_ungated(spark):
    frame = cases(spark, {}, {}, {}).withColumn(
        "current_ltv", F.lit(LOAN["current_balance"] / LOAN["property_value_current"]) + F.when(
            F.col("loan_id") == "LN-0000002", 0.006).otherwise(0.004))
    assert failures(frame) == {}  # the extra column makes every row invalid
    assert failures(frame, gated=False) == {2: ["ltv_consistency"]}
    zero = cases(spark, {"property_value_current": 0.0}).withColumn("current_ltv", F.lit(0.5))
    assert "no LTV" in rules.run_all_rules(zero, REFERENCE_DATE, gated=False).first()["message"]


def test_several_failures_keep_registry_order(spark):
    frame = cases(spark, {"current_balance": 400000.0, "property_value_current": 0.0,
                          "taxatie_date": date(2018, 1, 1)})
    assert failures(frame) == {1: ["negative_amortization", "ltv_consistency", "taxatie_freshness"]}


def test_passes_are_low_and_ok(spark):
    rows = rules.run_all_rules(cases(spark, {}), REFERENCE_DATE, include_passes=True).collect()
    assert len(rows) == 9
    assert {(r["severity"], r["message"], r["passed"]) for r in rows} == {("LOW", "OK", True)}
    single = rules.run_rule(cases(spark, {}, {"current_balance": 400000.0}), "negative_amortization",
                            REFERENCE_DATE, include_passes=True).collect()
    assert [r["passed"] for r in single] == [True, False]


def test_today_is_the_default_reference_date(spark):
    frame = cases(spark, {"taxatie_date": date(1990, 1, 1)}, {"taxatie_date": date(2100, 1, 1)})
    found = [r["loan_id"] for r in rules.run_all_rules(frame).collect()]
    assert found == ["LN-0000001"]


def test_own_rule(spark):
    rules.register_rule(
        "high_dscr", F.col("dscr") > 5, "LOW", "completeness", "Internal policy",
        F.format_string("dscr %.1f", F.col("dscr")))
    try:
        row = rules.run_all_rules(cases(spark, {"dscr": 6.0}), REFERENCE_DATE).first()
        assert (row["rule_name"], row["message"]) == ("high_dscr", "dscr 6.0")
    finally:
        rules.unregister_rule("high_dscr")
    with pytest.raises(ValueError):
        rules.register_rule("x", F.lit(True), "SEVERE", "integrity", "", F.lit(""))


def test_counts_flags_and_selection(spark):
    frame = cases(spark, {}, {"current_balance": 400000.0}, {"lgd": 9.0})
    counts = {r["rule_name"]: (r["loan_count"], r["failed_count"])
              for r in rules.rule_counts(frame, REFERENCE_DATE).collect()}
    assert counts["negative_amortization"] == (2, 1) and counts["nhg_cap"] == (2, 0)
    flags = rules.rule_flags(frame, REFERENCE_DATE).collect()
    assert [r["negative_amortization"] for r in flags] == [False, True]
    findings = rules.run_all_rules(frame, REFERENCE_DATE)
    assert rules.findings_at(findings, "CRITICAL").count() == 1
    assert rules.findings_at(findings, "HIGH").count() == 0
    hit = rules.flagged_loans(frame, findings, "negative_amortization").collect()
    assert [r["loan_id"] for r in hit] == ["LN-0000002"]


def test_empty_tape(spark):
    empty = cases(spark, {}).limit(0)
    assert rules.run_all_rules(empty, REFERENCE_DATE).count() == 0
    assert {r["failed_count"] for r in rules.rule_counts(empty, REFERENCE_DATE).collect()} == {0}

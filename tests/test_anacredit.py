from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from polderbook.operators import anacredit as a
from tests.rows import LOAN, REFERENCE_DATE, cases


def test_mapping_of_the_plain_loan(spark):
    row = a.map_tape(cases(spark, {})).first().asDict()
    assert len(row) == 32
    assert row["contract_identifier"] == "LN-0000001"
    assert row["inception_date"] == row["settlement_date"] == LOAN["origination_date"]
    assert row["type_of_interest_rate"] == "Fixed" and row["project_finance_loan"] is False
    assert row["ltv_at_origination"] == 0.857143
    assert row["current_ltv"] == LOAN["current_balance"] / LOAN["property_value_current"]
    assert row["performing_status"] == "Performing"
    assert row["default_status_of_instrument"] == "Not in default"
    assert row["type_of_protection"] == "Residential real estate"
    assert row["accounting_classification_ifrs9_stage"] == "Stage 1"
    assert row["accumulated_impairment_amount"] == LOAN["pd_12m"] * LOAN["lgd"] * LOAN["ead"]
    assert set(a.REQUIRED_ATTRIBUTES) <= set(row) and len(a.REQUIRED_ATTRIBUTES) == 18


def test_conditional_attributes(spark):
    rows = a.map_tape(cases(
        spark,
        {"rate_type": "VARIABEL", "rentevast_einddatum": None},
        {"nhg_flag": True},
        {"taxatie_type": "EXECUTIEWAARDE"},
        {"taxatie_type": "MODELMATIG"},
        {"ifrs9_stage": "3", "days_past_due": 100, "arrears_bucket": "90+"},
        {"ifrs9_stage": "2", "days_past_due": 95},
        {"unlikely_to_pay_flag": True},
        {"arrears_bucket": "90+"},
        {"restructured_flag": True},
        {"property_value_at_origination": 0.0},
        {"energy_label": "A++++"},
    )).collect()
    assert rows[0]["type_of_interest_rate"] == "Variable"
    assert rows[1]["type_of_protection"] == "Residential real estate + NHG guarantee"
    assert rows[2]["type_of_protection_value"] == "Notional amount"
    assert rows[3]["type_of_protection_value"] == "Other"
    assert (rows[4]["performing_status"], rows[4]["default_status_of_instrument"]) == (
        "Non-performing", "Default")
    assert rows[4]["accumulated_impairment_amount"] == LOAN["pd_lifetime"] * LOAN["lgd"] * LOAN["ead"]
    assert [rows[i]["performing_status"] for i in (5, 6, 7)] == ["Non-performing"] * 3
    assert (rows[8]["forbearance_status"], rows[8]["performing_status"]) == (
        "Forborne", "Performing")
    assert rows[9]["ltv_at_origination"] == 0.0
    assert rows[10]["energy_performance_certificate"] == "A++++"


def test_clean_attributes_conform(spark):
    row = a.check_conformance(a.map_tape(cases(spark, {}))).first()
    assert row["conforming"] and row["missing_attributes"] == [] and row["invalid_values"] == []


def test_tampered_attributes(spark):
    mapped = a.map_tape(cases(spark, {}))
    bad = a.check_conformance(mapped.withColumn("currency", F.lit("XYZ"))).first()
    assert bad["populated"] and not bad["enumerated"] and not bad["conforming"]
    assert bad["invalid_values"] == ["currency is 'XYZ', known are: EUR"]
    gone = a.check_conformance(mapped.drop("outstanding_nominal_amount")).first()
    assert not gone["populated"] and gone["missing_attributes"] == ["outstanding_nominal_amount"]
    empty = a.check_conformance(mapped.withColumn("real_estate_country", F.lit(""))).first()
    assert empty["missing_attributes"] == ["real_estate_country"]
    null = a.check_conformance(
        mapped.withColumn("forbearance_status", F.lit(None).cast("string"))).first()
    assert null["conforming"]  # optional attributes may be null


def test_portfolio_share(spark):
    row = a.portfolio_conformance(cases(spark, {}, {"lgd": 5.0})).first()
    assert (row["loan_count"], row["conforming_count"], row["conformance_share"]) == (1, 1, 1.0)
    none = a.portfolio_conformance(cases(spark, {"lgd": 5.0})).first()
    assert (none["loan_count"], none["conformance_share"]) == (0, 0.0)


def test_bad_row_raises_or_is_skipped(spark):
    frame = cases(spark, {}, {"lgd": 5.0})
    assert a.map_tape(frame, on_invalid="skip").count() == 1
    with pytest.raises(Exception, match="loan schema"):
        a.map_tape(frame).collect()
    with pytest.raises(ValueError):
        a.map_tape(frame, on_invalid="ignore")


def test_extended_attributes(spark):
    frame = cases(spark, {"restructured_flag": True, "energy_label": "A++++"},
                  {"restructured_flag": True, "rate_type": "VARIABEL"})
    rows = a.map_tape_extended(frame, REFERENCE_DATE).collect()
    assert rows[0]["energy_performance_certificate_capped"] == "A+++"
    assert [r["interest_rate_reset_frequency"] for r in rows] == ["At rentevast end", "Continuous"]
    assert rows[0]["reference_date"] == REFERENCE_DATE and rows[0]["repayment_rights"] is None
    dated = frame.withColumn("restructured_date", F.when(
        F.col("loan_id") == "LN-0000001", F.lit(date(2020, 1, 1))).otherwise(date(2024, 1, 1)))
    status = [r["forbearance_renegotiation_status"]
              for r in a.map_tape_extended(dated, REFERENCE_DATE).collect()]
    assert status == ["Not forborne", "Forborne"]


def test_one_defaulted_loan_marks_the_borrower(spark):
    frame = cases(
        spark, {"borrower_id": "A"}, {"borrower_id": "A", "ifrs9_stage": "3", "days_past_due": 99},
        {"borrower_id": "A", "ifrs9_stage": "3", "days_past_due": 99}, {"borrower_id": "B"})
    rows = {r["loan_id"][-1]: r["default_status_of_counterparty"]
            for r in a.counterparty_default_status(frame).collect()}
    assert rows == {"1": "Default", "2": "Default", "3": "Default", "4": "Not in default"}

from __future__ import annotations

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from polderbook.model import COLUMNS, FIELDS, TAPE_SCHEMA
from polderbook.operators import validation as v
from tests.rows import LOAN, cases, loan, tape


def found(frame):
    """``{loan number: [(field, code), ...]}`` in reporting order."""
    out: dict[int, list] = {}
    for r in v.schema_violations(frame).collect():
        out.setdefault(int(r["loan_id"][3:]), []).append((r["field"], r["code"]))
    return out


def _just_outside():
    """For every column of the model a value just beyond each of its limits, with the code it must get."""
    for f in FIELDS:
        step = 1 if f.kind == "int" else 1e-6
        if f.low is not None:
            yield {f.name: type(step)(f.low) - step}, f.name, "greater_than_equal"
        if f.high is not None:
            beyond = type(step)(f.high) + (0 if f.high_open else step)
            yield {f.name: beyond}, f.name, "less_than" if f.high_open else "less_than_equal"
        if f.kind == "enum":
            for value in ("", f"{f.allowed[0]} ", ",".join(f.allowed[:2]), f.allowed[-1].lower() + "x"):
                yield {f.name: value}, f.name, "enum"
        if f.min_len and f.name != "loan_id":
            yield {f.name: " " * f.min_len}, f.name, "string_too_short"
        if f.max_len:
            yield {f.name: "E" * (f.max_len + 1)}, f.name, "string_too_long"
        if f.pattern:
            for value in (LOAN[f.name][:-1], LOAN[f.name].lower(), LOAN[f.name][::-1]):
                yield {f.name: value}, f.name, "string_pattern_mismatch"


SINGLE_FIELD = [
    *_just_outside(),
    ({"dscr": float("nan")}, "dscr", "greater_than_equal"),
    ({"pd_lifetime": float("nan")}, "pd_lifetime", "less_than_equal"),
    ({"currency": "GBP"}, None, "currency_is_eur"),
    ({"maturity_date": LOAN["origination_date"]}, None, "maturity_after_origination"),
    ({"pd_lifetime": LOAN["pd_12m"] / 2}, None, "pd_lifetime_ge_pd_12m"),
    ({"ifrs9_stage": "3"}, None, "stage_3_backstop"),
    ({"repayment_type": "SPAAR"}, None, "hra_repayment_type"),
    ({"origination_date": date(2012, 12, 31)}, None, "hra_regime_start"),
]


def test_each_constraint_reports_its_own_violation(spark):
    result = found(cases(spark, *[c for c, _, _ in SINGLE_FIELD]))
    expected = {i: [(f, c)] for i, (_, f, c) in enumerate(SINGLE_FIELD, start=1)}
    assert result == expected


def test_valid_variants_pass(spark):
    frame = cases(
        spark, {}, {"rentevast_einddatum": None}, {"pc6": " 1011AB "},
        {"dscr": float("inf")}, {"property_value_current": 0.0}, {"pd_12m": 0.0},
        {"ifrs9_stage": "3", "days_past_due": 90}, {"ifrs9_stage": "3", "restructured_flag": True},
        {"ifrs9_stage": "3", "unlikely_to_pay_flag": True},
        {"origination_date": date(2013, 1, 1)},
        {"origination_date": date(2012, 12, 31), "tax_deduction_eligible": False},
    )
    assert v.validate_tape(frame) == 11
    assert found(frame) == {}
    assert v.valid_loans(frame).where("loan_id = 'LN-0000003'").first()["pc6"] == "1011AB"


def test_null_is_an_error_in_every_column_but_one(spark):
    nullable = [f.name for f in FIELDS if f.nullable]
    assert nullable == ["rentevast_einddatum"]
    names = [c for c in COLUMNS if c not in nullable and c != "loan_id"]
    result = found(cases(spark, *[{c: None} for c in names]))
    assert [result[i][0][0] for i in range(1, len(names) + 1)] == names
    assert all(len(x) == 1 for x in result.values())


def test_random_mutations_are_reported_exactly(spark):
    """Several broken columns per row: all of them, in column order, and no invariant."""
    rng = random.Random(7)
    broken = [
        (f.name, -5.0 if f.kind == "double" else -5 if f.kind == "int" else "?", f.kind)
        for f in FIELDS if f.kind in ("double", "int", "enum")
    ]
    rows, expected = [], {}
    for i in range(1, 81):
        picked = rng.sample(range(len(broken)), rng.randint(1, 6))
        rows.append({broken[p][0]: broken[p][1] for p in picked})
        expected[i] = [
            (broken[p][0], "enum" if broken[p][2] == "enum" else "greater_than_equal")
            for p in sorted(picked)
        ]
    frame = cases(spark, *rows)
    assert found(frame) == expected
    first = {int(r["loan_id"][3:]): (r["field"], r["code"])
             for r in v.first_issues(frame, ["loan_id"], 100).collect()}
    assert first == {i: e[0] for i, e in expected.items()}


def test_flag_filter_and_counts_agree(spark):
    frame = cases(spark, *[c for c, _, _ in SINGLE_FIELD], {}, {"rentevast_einddatum": None})
    flags = v.with_validity(frame)
    assert flags.where("is_valid").count() == 2
    assert flags.where("is_valid IS NULL").count() == 0
    assert v.valid_loans(frame).count() == 2
    counts = v.validity_counts(frame).first()
    assert (counts["row_count"], counts["valid_count"], counts["skipped_count"]) == (
        len(SINGLE_FIELD) + 2, 2, len(SINGLE_FIELD))
    with pytest.raises(ValueError, match=f"{len(SINGLE_FIELD)} of {len(SINGLE_FIELD) + 2}"):
        v.validate_tape(frame)


def test_missing_required_column_fails_every_row(spark):
    frame = cases(spark, {}, {}).drop("lgd", "dscr")
    assert found(frame) == {1: [("lgd", "missing"), ("dscr", "missing")],
                            2: [("lgd", "missing"), ("dscr", "missing")]}
    assert v.valid_loans(frame).count() == 0


def test_only_the_key_present(spark):
    frame = cases(spark, {}).select("loan_id")
    required = [f.name for f in FIELDS if f.required and f.name != "loan_id"]
    assert len(required) == 38
    assert [f for f, c in found(frame)[1] if c == "missing"] == required


def test_optional_columns_take_their_defaults(spark):
    optional = [f.name for f in FIELDS if not f.required]
    assert len(optional) == 9
    frame = cases(spark, {}).drop(*optional)
    row = v.valid_loans(frame).first()
    assert row["sicr_trigger_reason"] == "NONE"
    assert row["interest_only_portion"] == 0.0 and row["student_loan_debt"] == 0.0
    assert row["restructured_flag"] is False and row["rentevast_einddatum"] is None
    assert v.valid_loans(frame).schema.simpleString() == TAPE_SCHEMA.simpleString()


def test_unknown_column_fails_every_row_but_the_label_does_not(spark):
    frame = cases(spark, {}).withColumn("easter_egg", F.lit("x"))
    assert v.validate_tape(frame) == 1
    extra = frame.withColumn("current_ltv", F.lit(0.5))
    assert found(extra) == {1: [("current_ltv", "extra_forbidden")]}
    assert v.valid_loans(extra).count() == 0


def test_fields_come_before_unknown_columns(spark):
    frame = cases(spark, {"lgd": 2.0}).withColumn("zzz", F.lit(1))
    assert found(frame)[1] == [("lgd", "less_than_equal"), ("zzz", "extra_forbidden")]


def test_lax_parsing_of_text(spark):
    text = {k: None if x is None else str(x).lower() if isinstance(x, bool) else str(x)
            for k, x in LOAN.items()}
    variants = [
        ({}, None),
        ({"lgd": " 1.5e-1 "}, None),
        ({"lgd": "0.1d"}, ("lgd", "float_parsing")),
        ({"lgd": "abc"}, ("lgd", "float_parsing")),
        ({"nhg_flag": "yes"}, None),
        ({"nhg_flag": "2"}, ("nhg_flag", "bool_parsing")),
        ({"bouwjaar": "1995.0"}, None),
        ({"bouwjaar": "1995.5"}, ("bouwjaar", "int_parsing")),
        ({"maturity_date": "2048-06-01T00:00:00"}, None),
        ({"maturity_date": "2048-06-01T10:00:00"}, ("maturity_date", "date_parsing")),
        ({"maturity_date": "01-06-2048"}, ("maturity_date", "date_parsing")),
        ({"maturity_date": "2048-02-30"}, ("maturity_date", "date_parsing")),
        ({"rentevast_einddatum": "soon"}, ("rentevast_einddatum", "date_parsing")),
        ({"rentevast_einddatum": None}, None),
        ({"dscr": "inf"}, None),
        ({"dscr": None}, ("dscr", "float_type")),
        ({"ifrs9_stage": " 1"}, ("ifrs9_stage", "enum")),
        ({"loan_id": "  LN-0000018\t"}, None),
    ]
    rows = [{**text, "loan_id": f"LN-{i:07d}", **c} for i, (c, _) in enumerate(variants, 1)]
    schema = ", ".join(f"{c} string" for c in COLUMNS)
    frame = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], schema)
    assert found(frame) == {i: [e] for i, (_, e) in enumerate(variants, 1) if e}
    row = v.valid_loans(frame).where("loan_id = 'LN-0000018'").first()
    assert row["origination_date"] == LOAN["origination_date"] and row["bouwjaar"] == LOAN["bouwjaar"]
    assert row["nhg_flag"] is False and row["lgd"] == LOAN["lgd"]


def test_lax_conversion_of_other_types(spark):
    frame = (
        cases(spark, {}, {"days_past_due": 3})
        .withColumn("nhg_flag", F.when(F.col("loan_id") == "LN-0000001", 1).otherwise(2))
        .withColumn("days_past_due", F.col("days_past_due") + F.lit(0.5).cast("double")
                    * (F.col("loan_id") == "LN-0000002").cast("int"))
        .withColumn("maturity_date", F.lit(datetime(2048, 6, 1)))
        .withColumn("ead", F.col("ead").cast("decimal(18,2)"))
    )
    assert found(frame) == {2: [("nhg_flag", "bool_parsing"), ("days_past_due", "int_from_float")]}
    noon = frame.withColumn("maturity_date", F.lit(datetime(2048, 6, 1, 12)))
    assert found(noon)[1] == [("maturity_date", "date_from_datetime_inexact")]


def test_a_number_is_not_a_string(spark):
    frame = cases(spark, {}).withColumn("ifrs9_stage", F.lit(1)).withColumn("gemeente", F.lit(7))
    assert found(frame)[1] == [("gemeente", "string_type"), ("ifrs9_stage", "string_type")] or (
        found(frame)[1] == [("gemeente", "string_type"), ("ifrs9_stage", "enum")]
    )


def test_first_issues_keeps_at_least_one_row_in_order(spark):
    frame = cases(spark, {"lgd": 2.0}, {}, {"currency": "USD"}, {"pc6": "x"})
    assert [r["loan_id"] for r in v.first_issues(frame, ["loan_id"], 2).collect()] == [
        "LN-0000001", "LN-0000003"]
    assert v.first_issues(frame, ["loan_id"], 0).count() == 1


def test_row_index_is_carried(spark):
    frame = cases(spark, {"lgd": 2.0}, {}).withColumn("at", F.lit(41))
    row = v.schema_violations(frame, row_index="at").first()
    assert row["row_index"] == 41 and row["message"]


def test_empty_tape(spark):
    empty = tape(spark, loan()).limit(0)
    assert v.validate_tape(empty) == 0
    assert v.schema_violations(empty).count() == 0


def test_renamed_columns_plan_in_reasonable_time(spark, tmp_path):
    """Renames next to a wide filter once sent the optimizer into 2^n derived conditions."""
    from polderbook.operators import anacredit, rules
    from tests.rows import REFERENCE_DATE

    frame = cases(spark, {}, {"current_balance": 400000.0}, {"lgd": 2.0})
    frame.select(*[F.col(c).alias(f"src_{c}") for c in COLUMNS]).write.parquet(str(tmp_path / "t"))
    source = spark.read.parquet(str(tmp_path / "t"))
    renamed = source.select(*[F.col(f"src_{c}").alias(c) for c in COLUMNS])
    assert v.schema_violations(renamed).count() == 1
    assert v.first_issues(renamed, ["loan_id"]).count() == 1
    assert rules.run_all_rules(renamed, REFERENCE_DATE).count() == 1
    assert v.valid_loans(renamed).count() == 2
    assert anacredit.map_tape(renamed, "skip").count() == 2

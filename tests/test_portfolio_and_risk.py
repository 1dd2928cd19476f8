from __future__ import annotations

import random
from collections import Counter
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from polderbook.functions.bins import order_bin
from polderbook.operators import anomaly, drift, portfolio, sicr, stress, transitions
from tests.rows import LOAN, REFERENCE_DATE, cases


def test_vintage_arrears(spark):
    frame = cases(spark, {}, {}, {"arrears_bucket": "1-30"}, {"origination_date": date(2020, 1, 1)})
    out = {(r["vintage"], r["arrears_bucket"]): (r["loan_count"], r["share_of_vintage"])
           for r in portfolio.vintage_arrears(frame).collect()}
    assert out[(2019, "0")] == (2, pytest.approx(2 / 3)) and out[(2020, "0")] == (1, 1.0)
    wide = {r["vintage"]: r for r in portfolio.vintage_arrears_matrix(frame).collect()}
    assert wide[2019]["1-30"] == 1 and wide[2020]["90+"] == 0


def test_concentrations(spark):
    frame = cases(spark, {"pc6": "1011AA", "borrower_id": "A"}, {"pc6": "1011BB", "borrower_id": "A"},
                  {"pc6": "9711AA", "gemeente": "Groningen", "borrower_id": "B"})
    top = portfolio.concentration_pc4(frame).first()
    assert (top["pc4"], top["loan_count"], top["exposure_share"]) == ("1011", 2, pytest.approx(2 / 3))
    assert portfolio.borrower_concentration(frame, 1).collect()[0]["borrower_id"] == "A"
    assert portfolio.concentration_gemeente(frame.limit(0)).count() == 0


def test_ltv_bands_cover_everything(spark):
    frame = cases(spark, *[{"current_balance": b, "property_value_current": 100.0}
                           for b in (10.0, 50.0, 99.0, 100.0, 500.0)],
                  {"property_value_current": 0.0})
    out = [(r["band"], r["ltv_from"], r["ltv_to"], r["loan_count"])
           for r in portfolio.ltv_bands(frame, [1.0, 0.5]).collect()]
    assert out == [(0, None, 0.5, 2), (1, 0.5, 1.0, 2), (2, 1.0, None, 2)]


def test_waterfall_density_and_ecl(spark):
    frame = cases(spark, {}, {"rentevast_einddatum": None}, {"rentevast_einddatum": date(2035, 1, 1)}, {"rentevast_einddatum": date(2028, 12, 31)})
    out = [(r["expiry_year"], r["in_reset_wave"]) for r in portfolio.rentevast_waterfall(frame).collect()]
    assert out == [(None, False), (2028, True), (2035, False), (2039, False)]
    assert portfolio.rwa_density(frame).first()["rwa_density"] == pytest.approx(LOAN["risk_weight"])
    assert portfolio.rwa_density(frame.limit(0)).first()["rwa_density"] == 0.0
    assert portfolio.ecl_by_stage(frame).first()["ecl"] == pytest.approx(4 * LOAN["pd_12m"] * LOAN["lgd"] * LOAN["ead"])


def test_trend_changes(spark):
    frame = cases(spark, {"pd_12m": 0.01}, {"origination_date": date(2020, 1, 1), "pd_12m": 0.03})
    rows = {r["vintage"]: r for r in portfolio.vintage_trend(frame).collect()}
    assert rows[2019]["pd_change"] is None and rows[2020]["pd_change"] == pytest.approx(0.02)


def test_roll_rates_equal_the_join_even_with_repeated_ids(spark):
    rng = random.Random(3)
    buckets = ["0", "1-30", "31-60", "61-90", "90+"]

    def snapshot(n):
        return [(f"L{min(rng.randint(0, 60), 40)}", rng.choice(buckets), float(rng.randint(1, 9)))
                for _ in range(n)]

    before, after = snapshot(150), snapshot(170)
    want, money = Counter(), Counter()
    for i, b, x in before:
        for j, c, _ in after:
            if i == j:
                want[b, c] += 1
                money[b, c] += x
    schema = "loan_id string, arrears_bucket string, current_balance double"
    got = transitions.roll_rates(
        spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)).collect()
    assert {(r["from_bucket"], r["to_bucket"]): r["loan_count"] for r in got} == dict(want)
    assert {(r["from_bucket"], r["to_bucket"]): r["exposure"] for r in got} == pytest.approx(dict(money))
    for b in buckets:
        assert sum(r["roll_rate"] for r in got if r["from_bucket"] == b) == pytest.approx(1.0)


SICR_CASES = [
    ({"days_past_due": 30}, "DPD_30_BACKSTOP", "2"),
    ({"restructured_flag": True}, "FORBEARANCE", "2"),
    ({"watchlist_flag": True}, "WATCHLIST", "2"),
    ({"rentevast_einddatum": date(2026, 6, 1), "dscr": 1.1}, "MACRO_OVERLAY", "2"),
    ({"energy_label": "E", "bouwjaar": 1991}, "CLIMATE_TRANSITION", "2"),
    ({"days_past_due": 90}, "DPD_30_BACKSTOP", "3"),
    ({"unlikely_to_pay_flag": True}, "", "3"),
    ({"days_past_due": 29}, "", "1"),
    ({"rentevast_einddatum": date(2026, 6, 2), "dscr": 1.1}, "", "1"),
    ({"rentevast_einddatum": date(2025, 5, 31), "dscr": 1.1}, "", "1"),
    ({"rentevast_einddatum": date(2026, 6, 1), "dscr": 1.2}, "", "1"),
    ({"rentevast_einddatum": None, "dscr": 1.1}, "", "1"),
    ({"energy_label": "E", "bouwjaar": 1992}, "", "1"),
    ({"energy_label": "D", "bouwjaar": 1950}, "", "1"),
]


def test_sicr_triggers_and_stage(spark):
    frame = cases(spark, *[c for c, _, _ in SICR_CASES])
    rows = sicr.sicr_triggers(frame, REFERENCE_DATE).orderBy("loan_id").collect()
    assert [(r["sicr_reasons"], r["derived_stage"]) for r in rows] == [c[1:] for c in SICR_CASES]
    assert {r["sicr_quant_pd_increase"] for r in rows} == {None}
    soft = sicr.sicr_triggers(frame, REFERENCE_DATE, promote_climate=False).orderBy("loan_id").collect()
    assert (soft[4]["sicr_reasons"], soft[4]["derived_stage"]) == ("CLIMATE_TRANSITION", "1")


def test_quantitative_trigger_needs_ratio_and_uplift(spark):
    frame = cases(spark, {"pd_lifetime": 0.06}, {"pd_lifetime": 0.0061}, {"pd_lifetime": 0.05})
    start = F.when(F.col("loan_id") == "LN-0000002", F.lit(0.002)).otherwise(F.lit(0.02))
    rows = sicr.sicr_triggers(frame.withColumn(sicr.ORIGINATION_PD, start), REFERENCE_DATE).collect()
    assert [r["sicr_quant_pd_increase"] for r in rows] == [True, False, False]


def test_old_restructuring_is_no_trigger(spark):
    frame = cases(spark, {"restructured_flag": True}, {"restructured_flag": True}).withColumn(
        "restructured_date", F.when(F.col("loan_id") == "LN-0000001", F.lit(date(2023, 6, 30)))
        .otherwise(F.lit(date(2023, 5, 1))))
    rows = sicr.sicr_triggers(frame, REFERENCE_DATE).orderBy("loan_id").collect()
    assert [r["sicr_forbearance"] for r in rows] == [True, False]


def test_sicr_quality_and_transitions(spark):
    frame = cases(spark, *[c for c, _, _ in SICR_CASES])
    expected = F.col("loan_id") <= "LN-0000007"
    row = sicr.trigger_quality(frame, expected, REFERENCE_DATE).first()
    assert (row["recall"], row["specificity"]) == (1.0, 1.0)
    moves = {(r["reported_stage"], r["derived_stage"]): r["loan_count"]
             for r in sicr.stage_transitions(frame, REFERENCE_DATE).collect()}
    assert moves == {("1", "1"): 7, ("1", "2"): 5, ("1", "3"): 2}


def delta(frame):
    return stress.stress_check(frame, sanity_bound=1e9).first()


def test_no_shock_changes_nothing(spark):
    frame = cases(spark, {}, {"property_value_current": 0.0}, {"nhg_flag": True})
    for stressed in (
        stress.house_price_shock(frame, 0.0),
        stress.energy_transition(frame, {"G": 0.3}),
        stress.hra_phase_out(frame, new_rate=0.55, pd_response=5.0),
        stress.rate_reset(frame, date(2040, 1, 1), date(2041, 1, 1), pd_response=5.0),
    ):
        row = delta(stressed)
        assert row["el_delta"] == 0.0 and row["status"] == "OK" and row["non_finite"] == 0


def test_house_price_fall_raises_lgd_outside_nhg(spark):
    frame = cases(spark, {}, {"nhg_flag": True})
    rows = stress.house_price_shock(frame, -0.2).collect()
    after = LOAN["current_balance"] / (LOAN["property_value_current"] * 0.8)
    assert rows[0]["stressed_lgd"] == pytest.approx(LOAN["lgd"] + (after - after * 0.8) * 0.5)
    assert rows[1]["stressed_lgd"] == LOAN["lgd"]
    with pytest.raises(ValueError):
        stress.house_price_shock(frame, -1.0)


def test_cost_scenarios(spark):
    frame = cases(spark, {}, {"tax_deduction_eligible": False, "rentevast_einddatum": None})
    hra = stress.hra_phase_out(frame, new_rate=0.2697, pd_response=2.0).collect()
    assert hra[0]["stressed_pd"] == pytest.approx(LOAN["pd_12m"] * (1 + 2 * LOAN["current_balance"] * LOAN["interest_rate"] * (LOAN["hra_phase_out_rate"] - 0.2697) / LOAN["gross_household_income"]))
    assert hra[1]["stressed_pd"] == LOAN["pd_12m"]
    reset = stress.rate_reset(frame, date(2039, 1, 1), date(2039, 12, 31), pd_response=3.0).collect()
    assert reset[0]["stressed_pd"] == pytest.approx(LOAN["pd_12m"] * (1 + 3 * LOAN["current_balance"] * 0.02 / LOAN["gross_household_income"]))
    assert reset[1]["stressed_pd"] == LOAN["pd_12m"]


def test_stress_status(spark):
    shocked = stress.house_price_shock(cases(spark, {}), -0.5)
    total = delta(shocked)["el_delta"]
    assert stress.stress_check(shocked, sanity_bound=total / 3.1).first()["status"] == "FAILED"
    assert stress.stress_check(shocked, sanity_bound=total / 2.9).first()["status"] == "OK"
    broken = stress.house_price_shock(cases(spark, {"lgd": float("nan")}, {}), -0.5)
    assert stress.stress_check(broken, sanity_bound=1e9).first()["status"] == "FAILED"
    steps = stress.stress_summary(shocked).collect()
    assert sum(r["el_delta"] for r in steps) == pytest.approx(total)


def test_bins_keep_the_order(spark):
    rng = random.Random(1)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 1.7e308, float("inf"), float("-inf")]
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(3000)]
    values += [1.0 + i * 2.220446049250313e-16 for i in range(50)]
    frame = spark.createDataFrame([(x,) for x in values], "v double")
    rows = sorted((r["v"], r["b"]) for r in frame.select("v", order_bin(F.col("v")).alias("b")).collect())
    assert all(a[1] <= b[1] for a, b in zip(rows, rows[1:]))


def ks_reference(a, b):
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    return float(np.abs(fa - fb).max())


def test_ks_against_brute_force_with_a_hot_value(spark):
    rng = np.random.default_rng(5)
    hot = np.full(400, 0.25)
    a = {"x": np.concatenate([rng.normal(size=800), hot]), "y": rng.lognormal(10, 2, size=1200)}
    b = {"x": np.concatenate([rng.normal(0.2, 1.0, size=700), hot]), "y": rng.lognormal(10, 2, size=1100)}

    def frame(d):
        return spark.createDataFrame(
            [(float(x), float(y)) for x, y in zip(d["x"], d["y"])]
            + [(None, float("nan"))], "x double, y double")

    rows = {r["metric"]: r for r in drift.ks_drift(frame(a), frame(b), ["x", "y"]).collect()}
    for m in ("x", "y"):
        assert rows[m]["ks_statistic"] == pytest.approx(ks_reference(a[m], b[m]), abs=1e-12)
        assert (rows[m]["n_before"], rows[m]["n_after"]) == (len(a[m]), len(b[m]))
    assert rows["x"]["p_value"] < 0.01 < rows["y"]["p_value"]
    same = drift.ks_drift(frame(a), frame(a), ["x"]).first()
    assert same["ks_statistic"] == 0.0 and same["p_value"] == 1.0


def test_exact_medians_against_brute_force(spark):
    rng = np.random.default_rng(9)
    groups = {
        "odd": rng.normal(size=101), "even": rng.normal(size=100), "one": np.array([3.0]),
        "hot": np.concatenate([np.full(500, 7.0), rng.uniform(0, 10, 200)]),
        "split": np.array([-1e9, 1e9]), "zero": np.array([0.0, 0.0, -5.0, 4.0]),
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs]
    frame = spark.createDataFrame(rows, "g string, value double").repartition(5)
    got = {r["g"]: r["median"] for r in anomaly.exact_medians(frame, ["g"]).collect()}
    assert got == pytest.approx({g: float(np.median(x)) for g, x in groups.items()})


def test_robust_outliers_name_their_reason(spark):
    changes = [{"dscr": 1.0 + i / 100, "lgd": 0.1 + i / 1000} for i in range(30)]
    frame = cases(spark, *changes, {"dscr": 9.0, "lgd": 0.11}, {"dscr": 1.1, "lgd": None})
    out = anomaly.robust_outliers(frame, "repayment_type", ["dscr", "lgd", "interest_rate"], 4.0).collect()
    assert [(r["loan_id"], r["reasons"], r["degraded_mode"]) for r in out] == [
        ("LN-0000031", "dscr", True)]
    values = np.array([c["dscr"] for c in changes] + [9.0, 1.1])
    med = np.median(values)
    assert out[0]["max_abs_z"] == pytest.approx(
        (9.0 - med) / (1.4826 * np.median(np.abs(values - med))))


def test_repayment_mix_anomaly(spark):
    rows = []
    for year in range(2014, 2020):
        free = 5 if year == 2017 else 1 + year % 2
        rows += [{"origination_date": date(year, 1, 1), "tax_deduction_eligible": False,
                  "repayment_type": "AFLOSSINGSVRIJ" if i < free else "LINEAIR"} for i in range(8)]
    out = {r["vintage"]: r for r in anomaly.repayment_mix_anomaly(cases(spark, *rows)).collect()}
    assert [y for y, r in out.items() if r["is_anomaly"]] == [2017]
    others = [r["share"] for y, r in out.items() if y != 2017]
    assert out[2017]["z_score"] == pytest.approx(
        (0.625 - np.mean(others)) / np.std(others, ddof=1))


def test_drift_bins_follow_the_values(spark):
    rng = random.Random(3)
    values = {
        "close": [1.0 + rng.random() / 1000 for _ in range(20000)],
        "wide": [10 ** rng.uniform(-300, 300) * rng.choice([-1, 1]) for _ in range(20000)],
        "few": [float(rng.randrange(3)) for _ in range(20000)] + [float("inf"), float("-inf")],
    }
    rows = [(m, v, 1, 0) for m, vs in values.items() for v in dict.fromkeys(vs)]
    out = drift.with_bins(spark.createDataFrame(rows, "metric string, value double, n0 bigint, n1 bigint"), 64).collect()
    for metric, vs in values.items():
        placed = sorted((r["value"], r["bin"]) for r in out if r["metric"] == metric)
        assert [v for v, _ in placed] == sorted(set(vs))
        assert all(a[1] <= b[1] for a, b in zip(placed, placed[1:])) and 0 <= placed[0][1] and placed[-1][1] <= 63
        if metric != "few":
            sizes = Counter(b for _, b in placed)
            assert len(sizes) == 64 and max(sizes.values()) < 2 * 20000 / 64

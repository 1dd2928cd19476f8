from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from polderbook.operators import bridge, stress
from tests.rows import cases

LOANS = (
    {}, {"current_balance": 310000.0, "ifrs9_stage": "2"}, {"nhg_flag": True}, {"pd_lifetime": 0.9, "ifrs9_stage": "3"},
    {"gross_household_income": 0.0}, {"property_value_current": 0.0}, {"origination_date": date(2012, 5, 1), "lgd": 0.97},
)


def house():
    return bridge.Shock(value_factor=F.lit(0.7))


def cost():
    return bridge.Shock(yearly_cost=F.col("current_balance") * 0.02, pd_response=5.0)


def steps(frame, shocks, bound=1e9):
    return {r["step"]: r for r in bridge.loss_bridge(frame, shocks, bound).orderBy("position").collect()}


def test_single_shock_equals_the_scenario(spark):
    frame = cases(spark, *LOANS)
    out = steps(frame, {"house": house()})
    total = stress.stress_check(stress.house_price_shock(frame, -0.3), 1e9).first()
    assert float(out["house"]["amount"]) == pytest.approx(total["el_delta"], abs=1e-4)
    assert float(out["stressed"]["amount"]) == pytest.approx(total["stressed_el"], abs=1e-4)
    assert float(out["interaction"]["amount"]) == pytest.approx(0.0, abs=1e-6)


def test_steps_add_up_and_interaction_is_what_shocks_do_together(spark):
    frame = cases(spark, *LOANS)
    both = steps(frame, {"house": house(), "cost": cost()})
    alone = tuple(steps(frame, {"x": s})["x"]["amount"] for s in (house(), cost()))
    assert (both["house"]["amount"], both["cost"]["amount"]) == alone
    assert list(both) == ["base", "house", "cost", "interaction", "stressed"]
    assert both["interaction"]["amount"] > 0
    total = sum(r["amount"] for name, r in both.items() if name != "stressed")
    assert abs(total - both["stressed"]["amount"]) == both["stressed"]["gap"] < 1e-4
    assert both["interaction"]["cumulative"] == total and {r["status"] for r in both.values()} == {"OK"}


def test_amounts_do_not_depend_on_the_order_of_loans(spark):
    frame = cases(spark, *[{"current_balance": 1e5 + 0.1 * i, "lgd": 0.01 + i / 1000} for i in range(200)])
    assert steps(frame.coalesce(1), {"a": house(), "b": cost()}) == steps(
        frame.orderBy(F.desc("loan_id")).repartition(5), {"a": house(), "b": cost()})


def test_failures(spark):
    frame = cases(spark, *LOANS)
    rise = float(steps(frame, {"house": house()})["house"]["amount"])
    assert steps(frame, {"house": house()}, rise / 3.1)["base"]["status"] == "FAILED"
    assert steps(frame, {"house": house()}, rise / 2.9)["base"]["status"] == "OK"
    for odd in (None, float("nan"), float("inf")):
        out = steps(cases(spark, *LOANS, {"lgd": odd}), {"house": house()})
        assert (out["base"]["status"], out["base"]["non_finite"]) == ("FAILED", 1)
        assert out["stressed"]["amount"] == steps(frame, {"house": house()})["stressed"]["amount"]


def test_no_shock_no_loan_and_names(spark):
    assert [r["amount"] for r in steps(cases(spark, {}).limit(0), {"a": house()}).values()] == [0] * 4
    assert list(steps(cases(spark, {}), {})) == ["base", "interaction", "stressed"]
    with pytest.raises(ValueError):
        bridge.loss_bridge(cases(spark, {}), {"base": house()}, 1.0)


def test_reads_the_tape_once(spark, tmp_path):
    cases(spark, *LOANS).write.parquet(str(tmp_path / "tape"))
    frame = bridge.loss_bridge(spark.read.parquet(str(tmp_path / "tape")), {"a": house(), "b": cost()}, 1e9)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1

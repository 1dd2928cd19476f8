from __future__ import annotations

import pytest

from polderbook.operators import gate, isolation, stress
from polderbook.sources import reader
from tests.rows import REFERENCE_DATE, cases

METRICS = ("dscr", "current_balance")


def shocked(tape):
    return stress.house_price_shock(tape, -0.2)


def lines(frame):
    return {r["stage"]: (r["status"], r["checked_count"], r["flagged_count"]) for r in frame.collect()}


@pytest.fixture(scope="module")
def tape(spark):
    odd = ({"dscr": 80.0, "current_balance": 1.0}, {"lgd": 2.0}, {"current_balance": 250000.0}, {"ifrs9_stage": "3"})
    return cases(spark, *[{"dscr": 1.0 + i / 50, "current_balance": 1e5 + 1000.0 * i} for i in range(60)], *odd)


def test_equal_to_the_gates_that_scan_on_their_own(tape, tmp_path):
    forest = isolation.fit(tape, METRICS)
    found = lines(gate.write_with_gates(tape, str(tmp_path / "t"), REFERENCE_DATE, shocked, 1e9, forest))
    assert {s: found[s] for s in ("ingest", "validation", "anacredit", "quick_scan")} == lines(
        gate.stage_gates(tape, REFERENCE_DATE))
    assert found["stress"] == ("OK", 64, 0)
    listed = isolation.score(tape, forest).where("is_anomaly").count()
    assert found["anomaly"] == ("OK", 64, listed) and listed > 0


def test_the_tape_is_written_as_it_is(spark, tape, tmp_path):
    forest = isolation.fit(tape, METRICS)
    gate.write_with_gates(tape, str(tmp_path / "t"), REFERENCE_DATE, shocked, 1e9, forest)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.columns == reader.payload(tape).columns and back.exceptAll(reader.payload(tape)).isEmpty()
    assert back.count() == tape.count()


def test_stress_and_degraded_rows(spark, tape, tmp_path):
    change = abs(stress.stress_check(shocked(tape), 1e9).first()["el_delta"])
    tight = lines(gate.write_with_gates(tape, str(tmp_path / "a"), REFERENCE_DATE, shocked, change / 3.1))
    assert tight["stress"] == ("FAILED", 64, 0) and tight["anomaly"] == ("DEGRADED", 64, None)
    lost = cases(spark, {}, {"lgd": None}, {"pd_12m": float("nan")})
    found = lines(gate.write_with_gates(lost, str(tmp_path / "b"), REFERENCE_DATE, shocked, 1e9))
    assert found["stress"] == ("FAILED", 3, 2) and found["ingest"] == ("FAILED", 3, 2)
    assert found["quick_scan"][0] == "FAILED"
    plain = lines(gate.write_with_gates(lost, str(tmp_path / "c"), REFERENCE_DATE))
    assert "stress" not in plain


def test_empty_tape(tape, tmp_path):
    found = lines(gate.write_with_gates(tape.limit(0), str(tmp_path / "t"), REFERENCE_DATE, shocked, 1.0))
    assert {s: r[0] for s, r in found.items()} == {
        "ingest": "OK", "validation": "OK", "anacredit": "OK", "quick_scan": "OK", "stress": "OK", "anomaly": "DEGRADED"}


def test_one_scan_and_no_shuffle(spark, tape, tmp_path):
    tape.write.parquet(str(tmp_path / "in"))
    stored = spark.read.parquet(str(tmp_path / "in"))
    group = f"gates-{tmp_path.name}"
    spark.sparkContext.setJobGroup(group, "gates")
    try:
        gate.write_with_gates(stored, str(tmp_path / "out"), REFERENCE_DATE, shocked, 1e9)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    assert len(jobs) == 1 and len(jobs[0].stageIds) == 1

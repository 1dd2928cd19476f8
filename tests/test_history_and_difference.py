from __future__ import annotations

import collections
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from polderbook.operators import difference, gate, history, sicr
from tests.rows import REFERENCE_DATE, cases

TAPE = "loan_id string, a int, b double, note string"
SNAPSHOTS = (
    "loan_id string, snapshot_date date, pd_lifetime double, restructured_flag boolean, days_past_due int, "
    "unlikely_to_pay_flag boolean, ifrs9_stage string"
)


def brute_difference(before, after):
    net = collections.Counter(before)
    net.subtract(after)
    by = collections.defaultdict(list)
    for row, n in net.items():
        if n:
            by[row[0]].append((row, n))
    out = []
    for key, rows in by.items():
        if len(rows) == 2 and rows[0][1] == -rows[1][1]:
            listed = ",".join(c for c, x, y in zip(("loan_id", "a", "b", "note"), rows[0][0], rows[1][0]) if x != y)
            out.append((key, "changed", abs(rows[0][1]), listed))
        else:
            out += [(key, "removed" if n > 0 else "added", abs(n), None) for _, n in rows]
    return sorted(out, key=str)


def test_difference_against_multisets(spark):
    rng = random.Random(8)

    def row(i):
        return (None if i % 50 == 0 else f"L{i % 120}", rng.choice([1, 2, None]), rng.choice([0.5, None]), rng.choice(["x", None]))

    before = [row(i) for i in range(400)]
    after = [r if rng.random() < 0.9 else row(i) for i, r in enumerate(before) if rng.random() < 0.95] + [("new", 1, 2.0, None)] * 2
    frames = [spark.createDataFrame(x, TAPE) for x in (before, after)]
    got = difference.tape_difference(frames[0].repartition(3), frames[1].repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute_difference(before, after)
    assert difference.tape_difference(frames[0], frames[0].orderBy("a")).count() == 0
    assert difference.tape_difference(frames[0], frames[0].limit(0)).where("change = 'removed'").agg(F.sum("copies")).first()[0] == 400
    with pytest.raises(ValueError):
        difference.tape_difference(frames[0], frames[1].drop("a"))


def test_fingerprints_ignore_order_and_count_copies(spark):
    rows = [("a", 1, None, "x"), ("a", None, 1.0, "x"), ("b", 1, 1.0, None)]
    one = difference.fingerprints(spark.createDataFrame(rows, TAPE), "loan_id").collect()
    other = difference.fingerprints(spark.createDataFrame(rows[::-1], TAPE).repartition(3), "loan_id").collect()
    twice = difference.fingerprints(spark.createDataFrame([*rows, rows[0]], TAPE), "loan_id").collect()
    assert sorted(one) == sorted(other) and sorted(one) != sorted(twice)
    moved = difference.fingerprints(spark.createDataFrame([("a", 1, 1.0, "x"), ("a", None, None, "x"), rows[2]], TAPE), "loan_id")
    assert sorted(moved.collect()) != sorted(one)


def day(year, month):
    return date(year, month, 1)


def snapshot(loan, year, month, pd=0.1, restructured=False, dpd=0, utp=False, stage="1"):
    return (loan, day(year, month), pd, restructured, dpd, utp, stage)


def test_first_values_grow_by_one_tape_at_a_time(spark):
    rows = [snapshot("a", 2023, 1, 0.01), snapshot("a", 2024, 1, 0.5), snapshot("b", 2024, 1, 0.2), snapshot("a", 2025, 1, 0.9),
            snapshot("c", 2025, 1, 0.3), snapshot(None, 2023, 1, 0.9), snapshot("b", 2024, 1, 0.1)]
    whole = spark.createDataFrame(rows, SNAPSHOTS)
    at_once = sorted(map(tuple, history.first_values(whole, ["pd_lifetime"]).collect()))
    assert at_once == [("a", day(2023, 1), 0.01), ("b", day(2024, 1), 0.1), ("c", day(2025, 1), 0.3)]
    known = None
    for year in (2025, 2023, 2024):  # also when an older tape arrives late
        known = history.first_values(whole.where(F.year("snapshot_date") == year), ["pd_lifetime"], known=known)
    assert sorted(map(tuple, known.collect())) == at_once


def test_origination_pd_feeds_the_trigger(spark):
    tape = cases(spark, {"loan_id": "a", "pd_lifetime": 0.30}, {"loan_id": "b", "pd_lifetime": 0.30}, {"loan_id": "new", "pd_lifetime": 0.30})
    first = spark.createDataFrame([("a", day(2023, 1), 0.1), ("b", day(2023, 1), 0.2)], "loan_id string, first_seen date, pd_lifetime double")
    got = sicr.sicr_triggers(history.with_origination_pd(tape, first), REFERENCE_DATE)
    assert {r[0]: r[1] for r in got.select("loan_id", "sicr_quant_pd_increase").collect()} == {"a": True, "b": False, "new": None}


def test_spells_and_events(spark):
    rows = [
        *[snapshot("x", 2022, m, restructured=m in (2, 3, 5)) for m in (1, 2, 3, 4, 5, 6)],
        snapshot("y", 2023, 5, restructured=None), snapshot("y", 2023, 7, restructured=True), snapshot("y", 2023, 7, restructured=False),
        snapshot("z", 2024, 1, dpd=90), snapshot("z", 2024, 2, dpd=89), snapshot("z", 2024, 3, utp=True), snapshot("z", 2024, 4, stage="3"),
        snapshot("cured", 2024, 1, dpd=120), snapshot("cured", 2024, 2), snapshot("late", 2026, 1, dpd=500),
    ]
    frame = spark.createDataFrame(rows, SNAPSHOTS)
    spells = history.spells(frame, F.col("restructured_flag")).collect()
    assert sorted(map(tuple, spells)) == [
        ("x", day(2022, 2), day(2022, 3), 2), ("x", day(2022, 5), day(2022, 5), 1), ("y", day(2023, 7), day(2023, 7), 1)]

    def events(on):
        return sorted(map(tuple, history.credit_events(frame, F.lit(on)).collect()))

    assert events(date(2025, 7, 1)) == [("x", day(2022, 5), False, None), ("y", day(2023, 7), True, None), ("z", None, False, day(2024, 3))]
    assert events(date(2025, 7, 2))[1] == ("y", day(2023, 7), False, None)  # 24 months are over
    assert history.credit_events(frame.limit(0), F.lit(day(2025, 1))).count() == 0


def test_a_run_recorded_twice_has_one_set_of_rows(spark, tmp_path):
    tape = cases(spark, {}, {"loan_id": "bad", "lgd": 2.0}, {"loan_id": "worse", "pc6": None})
    gates, payload = gate.stage_gates(tape, REFERENCE_DATE), gate.error_payload(tape)
    path = str(tmp_path / "ledger")
    for run in ("r1", "r2", "r1"):
        gate.append_to_ledger(gates, path, run, "t", REFERENCE_DATE, payload)
    rows = gate.read_ledger(spark, path).collect()
    assert collections.Counter((r["run_id"], r["stage"]) for r in rows) == {
        (run, stage): 1 for run in ("r1", "r2") for stage in ("ingest", "validation", "anacredit", "quick_scan")}
    quoted = {r["error_payload"] for r in rows if r["stage"] == "ingest"}
    assert len(quoted) == 1 and '"loan_id":"bad","field":"lgd"' in quoted.pop()
    assert all(r["error_payload"] is None for r in rows if r["stage"] != "ingest")
    assert gate.error_payload(cases(spark, {})).collect()[0][0] is None

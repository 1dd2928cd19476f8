from __future__ import annotations

import bisect
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from polderbook.operators.asof import asof_join

LOANS = "loan_id bigint, year int, income double, factor string"
BANDS = "year int, income double, pct double, note string"


def brute(loans, bands, first):
    best = {}
    for year, income, pct, note in bands:
        if income is not None:
            best[year, income] = max(best.get((year, income), (-1.0, "")), (pct, note))
    starts = {}
    for year, income in sorted(best, key=lambda k: (k[0] is None, k)):
        starts.setdefault(year, []).append(income)
    out = []
    for loan_id, year, income, factor in loans:
        mine = starts.get(year, [])
        i = bisect.bisect_right(mine, income) - 1 if income is not None else None
        known = (None, None) if not mine or i is None or (i < 0 and not first) else best[year, mine[max(i, 0)]]
        out.append((loan_id, year, income, factor, *known))
    return sorted(out, key=str)


@pytest.mark.parametrize("first", [False, True])
def test_against_brute_force(spark, first):
    rng = random.Random(3)
    years = [2020] * 8 + [2021, 2022, None]
    loans = [(i, rng.choice(years), rng.choice([None, float(rng.randint(0, 300))]) if i % 9 == 0 else float(rng.randint(0, 300)), "x")
             for i in range(3000)]
    bands = [(rng.choice([2020, 2020, 2021, None]), float(rng.randint(20, 280)), float(rng.randint(1, 9)), "n") for _ in range(150)]
    bands.append((2020, None, 99.0, "no place"))
    got = asof_join(
        spark.createDataFrame(loans, LOANS).repartition(7), spark.createDataFrame(bands, BANDS).repartition(3),
        ["year"], "income", ["pct", "note"], "first" if first else "null")
    assert got.columns == ["loan_id", "year", "income", "factor", "pct", "note"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(loans, bands, first)


def test_many_bands_equal_the_as_of_join_of_another_engine(spark):
    bands = spark.range(100_000).select(
        (F.col("id") % 4 + 2020).cast("int").alias("year"), (F.col("id") * 7 % 1_000_003).cast("double").alias("income"),
        (F.col("id") % 97).cast("double").alias("pct"))
    loans = spark.range(50_000).select(
        "id", F.when(F.col("id") % 3 > 0, 2020).otherwise(2021 + F.col("id") % 5).cast("int").alias("year"),
        (F.col("id") * 13 % 999_983).cast("double").alias("income"))
    got = asof_join(loans, bands, ["year"], "income", ["pct"])
    con = duckdb.connect()
    con.execute("CREATE TABLE bands AS SELECT CAST(i % 4 + 2020 AS INT) AS year, CAST(i * 7 % 1000003 AS DOUBLE) AS income, CAST(i % 97 AS DOUBLE) AS pct FROM range(100000) r(i)")
    con.execute("CREATE TABLE loans AS SELECT i AS id, CAST(CASE WHEN i % 3 > 0 THEN 2020 ELSE 2021 + i % 5 END AS INT) AS year, CAST(i * 13 % 999983 AS DOUBLE) AS income FROM range(50000) r(i)")
    want = con.execute("SELECT l.id, l.year, l.income, b.pct FROM loans l ASOF LEFT JOIN bands b ON l.year = b.year AND l.income >= b.income").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_empty_sides_and_a_wrong_mode(spark):
    loans, bands = spark.createDataFrame([(1, 2020, 5.0, "x")], LOANS), spark.createDataFrame([(2020, 1.0, 2.0, "n")], BANDS)
    assert asof_join(loans, bands.limit(0), ["year"], "income", ["pct"]).collect()[0]["pct"] is None
    assert asof_join(loans.limit(0), bands, ["year"], "income", ["pct"]).count() == 0
    with pytest.raises(ValueError):
        asof_join(loans, bands, ["year"], "income", ["pct"], "nearest")

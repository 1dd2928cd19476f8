from __future__ import annotations

import math
import random

import pytest

from polderbook.operators import isolation
from tests.rows import cases

METRICS = ("current_balance", "interest_rate", "dscr", "days_past_due")
ODD = {
    17: {"dscr": 60.0}, 140: {"interest_rate": 0.8, "current_balance": 9e6}, 333: {"days_past_due": 4000, "dscr": 0.0},
}


@pytest.fixture(scope="module")
def portfolio(spark):
    draw = random.Random(5)
    rows = []
    for i in range(1, 501):
        row = {"current_balance": draw.gauss(2e5, 3e4), "interest_rate": draw.uniform(0.01, 0.04),
               "dscr": draw.gauss(1.5, 0.2), "days_past_due": draw.choice([0, 0, 0, 5, 10])}
        rows.append(row | ODD.get(i, {}))
    rows[400] |= {"dscr": None, "interest_rate": float("nan"), "current_balance": float("inf")}
    return rows, cases(spark, *rows)


def walk(forest, row):
    """Mean path and the log gains per metric, by following the nodes."""
    values = [row[m] if row[m] is not None and math.isfinite(row[m]) else f for m, f in zip(forest.metrics, forest.fill)]
    paths, gains = [], dict.fromkeys(forest.metrics, 0.0)
    for tree in forest.trees:
        at = 1
        while tree[at][3] is None:
            metric, split, rows, _ = tree[at]
            at = 2 * at + (values[metric] >= split)
            gains[forest.metrics[metric]] += math.log(rows / tree[at][2])
        paths.append(tree[at][3])
    return sum(paths) / len(paths), gains


def test_scores_equal_a_walk_of_the_trees(portfolio):
    rows, frame = portfolio
    forest = isolation.fit(frame, METRICS)
    out = {r["loan_id"]: r for r in isolation.score(frame, forest, threshold=0.0).collect()}
    assert len(out) == len(rows)
    for i, row in enumerate(rows, start=1):
        mean, gains = walk(forest, row)
        got = out[f"LN-{i:07d}"]
        assert got["score"] == pytest.approx(2 ** (-mean / isolation.expected_path(forest.tree_rows)))
        best = [gains[m] for m in got["reasons"].split(",")]
        assert best == pytest.approx(sorted(gains.values(), reverse=True)[:3])


def test_planted_outliers_rank_first_with_their_metric(portfolio):
    rows, frame = portfolio
    forest = isolation.fit(frame, METRICS)
    ranked = isolation.score(frame, forest, threshold=0.0).orderBy("score", ascending=False).collect()
    first = {r["loan_id"]: r["reasons"].split(",")[0] for r in ranked[: len(rows) // 100]}
    for number, changes in ODD.items():
        assert first[f"LN-{number:07d}"] in changes


def test_sample_is_bounded_and_does_not_depend_on_partitions(portfolio):
    _, frame = portfolio
    small = {"trees": 5, "tree_rows": 16, "sample_rows": 60}
    one = isolation.fit(frame.coalesce(1), METRICS, **small)
    assert one == isolation.fit(frame.repartition(7), METRICS, **small)
    assert all(tree[1][2] == 16 for tree in one.trees)


def test_equal_loans_and_columns_without_values(spark):
    frame = cases(spark, *[{"dscr": None}] * 40)
    forest = isolation.fit(frame, METRICS, trees=3)
    rows = isolation.score(frame, forest).collect()
    assert {r["score"] for r in rows} == {0.5} and not any(r["is_anomaly"] or r["reasons"] for r in rows)


def test_falls_back_to_the_rule_based_list(spark):
    frame = cases(spark, *[{"dscr": 1.0 + i / 100} for i in range(20)], {"dscr": 50.0})
    assert isolation.fit(frame, METRICS) is None
    assert isolation.fit(frame.limit(0), METRICS) is None
    out = isolation.anomalies(frame, "repayment_type", METRICS).collect()
    assert [(r["loan_id"], r["reasons"], r["degraded_mode"]) for r in out] == [("LN-0000021", "dscr", True)]


def test_scoring_is_map_only(portfolio):
    _, frame = portfolio
    forest = isolation.fit(frame, METRICS, trees=3)
    plan = isolation.score(frame, forest)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

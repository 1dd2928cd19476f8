"""Isolation forest: trees grown on a bounded sample, every loan scored in a map.

A tree splits a sample at random until rows stand alone; odd loans stand alone after
few splits. Nodes are numbered like a heap (children of ``i`` are ``2i`` and ``2i + 1``),
so the end node of a loan also names every node on its way, and the reasons of a loan
need no second walk. Tasks receive the forest with their code; scoring is map-only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.operators.anomaly import robust_outliers

#: Trees of a forest and sampled loans per tree.
TREES, TREE_ROWS = 100, 256
#: Loans that reach the driver to grow a forest, whatever the size of the tape.
SAMPLE_ROWS = TREES * TREE_ROWS
#: Score from which a loan is listed; 0.5 is what a loan without peculiarity gets at most.
THRESHOLD = 0.6
#: Below this many loans there is nothing to compare with, and the rule-based list takes over.
MIN_LOANS = 32

_METRIC, _SPLIT, _ROWS, _PATH = range(4)


def expected_path(rows: int) -> float:
    """Mean number of splits that tell ``rows`` rows apart."""
    if rows < 2:
        return 0.0
    return 2.0 * sum(1.0 / i for i in range(1, rows)) - 2.0 * (rows - 1) / rows


@dataclass(frozen=True, eq=True)
class Forest:
    """Metrics, the values that stand in for missing ones, and trees of heap-numbered nodes.

    A node is ``(metric, split, rows, path)`` or None; ``path`` is set on end nodes only.
    """

    metrics: tuple[str, ...]
    fill: tuple[float, ...]
    trees: tuple[tuple[tuple | None, ...], ...]
    tree_rows: int

    @property
    def depth(self) -> int:
        return len(self.trees[0]).bit_length() - 2

    def part(self, which: int, absent: float) -> np.ndarray:
        """One part of every node as trees x nodes."""
        return _part(self, which, absent)


@lru_cache(maxsize=8)
def _part(forest: Forest, which: int, absent: float) -> np.ndarray:
    return np.array(
        [[absent if n is None or n[which] is None else n[which] for n in t] for t in forest.trees], dtype=float)


def _grow(values: np.ndarray, depth: int, draw: np.random.Generator) -> tuple[tuple | None, ...]:
    nodes: list[tuple | None] = [None] * 2 ** (depth + 1)
    open_nodes = [(1, values)]
    while open_nodes:
        at, part = open_nodes.pop()
        level = at.bit_length() - 1
        spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0))
        if level == depth or not len(spread):
            nodes[at] = (None, None, len(part), level + expected_path(len(part)))
            continue
        metric = int(draw.choice(spread))
        low, high = part[:, metric].min(), part[:, metric].max()
        split = float(low + (high - low) * draw.random())
        left = part[:, metric] < split
        if not left.any():  # rounded down to the smallest value
            split = float(high)
            left = part[:, metric] < split
        nodes[at] = (metric, split, len(part), None)
        open_nodes += [(2 * at, part[left]), (2 * at + 1, part[~left])]
    return tuple(nodes)


def _number(metric: str) -> Column:
    """The metric as a finite double, else null."""
    value = F.col(metric).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def fit(
    tape: DataFrame, metrics: Sequence[str], trees: int = TREES, tree_rows: int = TREE_ROWS,
    sample_rows: int = SAMPLE_ROWS, seed: int = 0,
) -> Forest | None:
    """A forest grown on the ``sample_rows`` loans with the smallest hashes; None below ``MIN_LOANS`` loans.

    The sample is a top list, combined per partition, so it does not depend on how the tape
    is split. Missing, NaN and infinite values count as the sample's median of the metric.
    """
    values = [_number(m).alias(m) for m in metrics]
    order = F.xxhash64(F.lit(seed), F.col("loan_id"))
    sample = tape.select(order.alias("__order"), *values).orderBy("__order", *metrics).limit(sample_rows)
    rows = np.array([tuple(r)[1:] for r in sample.collect()], dtype=float).reshape(-1, len(metrics))
    if len(rows) < MIN_LOANS:
        return None
    known = [rows[~np.isnan(rows[:, i]), i] for i in range(len(metrics))]
    fill = tuple(float(np.median(k)) if len(k) else 0.0 for k in known)
    rows = np.where(np.isnan(rows), fill, rows)
    size = min(tree_rows, len(rows))
    draw = np.random.default_rng(seed)
    grown = tuple(
        _grow(rows[draw.choice(len(rows), size, replace=False)], math.ceil(math.log2(size)), draw) for _ in range(trees)
    )
    return Forest(tuple(metrics), fill, grown, size)


def end_nodes(forest: Forest, values: np.ndarray) -> np.ndarray:
    """Number of the end node per row of ``values`` and tree; all rows take a step together."""
    metric, split = forest.part(_METRIC, -1), forest.part(_SPLIT, 0.0)
    tree = np.arange(len(forest.trees))
    at = np.ones((len(values), len(tree)), dtype=np.int64)
    for _ in range(forest.depth):
        tested = metric[tree, at].astype(np.int64)
        right = np.take_along_axis(values, np.maximum(tested, 0), axis=1) >= split[tree, at]
        at = np.where(tested < 0, at, 2 * at + right)
    return at


def gains(forest: Forest, ends: np.ndarray) -> np.ndarray:
    """What each metric did to single a row out, per row.

    A split earns the logarithm of the share of sampled rows that it leaves behind, so it
    counts for a loan that goes with few and hardly for one that goes with many.
    """
    metric, rows = forest.part(_METRIC, -1), forest.part(_ROWS, 0)
    tree, total = np.arange(len(forest.trees)), np.zeros((len(ends), len(forest.metrics)))
    for level in range(forest.depth):
        child, parent = ends >> level, ends >> (level + 1)
        row, column = np.nonzero(parent)
        up, down = parent[row, column], child[row, column]
        earned = np.log(rows[tree[column], up] / rows[tree[column], down])
        np.add.at(total, (row, metric[tree[column], up].astype(np.int64)), earned)
    return total


def _scored(forest: Forest, threshold: float, reasons: int, batch: pd.DataFrame) -> pd.DataFrame:
    values = batch[list(forest.metrics)].to_numpy(dtype=float)
    ends = end_nodes(forest, values)
    path = forest.part(_PATH, 0.0)[np.arange(len(forest.trees)), ends].mean(axis=1)
    score = 2.0 ** (-path / expected_path(forest.tree_rows))
    odd = score >= threshold
    why = np.full(len(batch), None, dtype=object)
    earned = gains(forest, ends[odd])
    for row, best in zip(np.flatnonzero(odd), np.argsort(-earned, axis=1, kind="stable")):
        own = earned[np.searchsorted(np.flatnonzero(odd), row)]
        why[row] = ",".join(forest.metrics[m] for m in best[:reasons] if own[m] > 0)
    return pd.DataFrame({"loan_id": batch["loan_id"], "score": score, "is_anomaly": odd, "reasons": why, "degraded_mode": False})


def score(tape: DataFrame, forest: Forest, threshold: float = THRESHOLD, reasons: int = 3) -> DataFrame:
    """Per loan: ``score`` (0 to 1, higher is odder), ``is_anomaly``, and the reasons of anomalies.

    Missing values count as the sample's median, so a loan without any value scores like a typical one.
    Batches of narrow columns pass through numpy: the same walk as a SQL expression over arrays took
    1.5 ms a loan, some thirty times as long.
    """
    filled = [F.coalesce(_number(m), F.lit(v)).alias(m) for m, v in zip(forest.metrics, forest.fill)]
    return tape.select("loan_id", *filled).mapInPandas(
        lambda batches: (_scored(forest, threshold, reasons, b) for b in batches),
        "loan_id string, score double, is_anomaly boolean, reasons string, degraded_mode boolean")


def score_column(forest: Forest) -> Column:
    """The score as a column of the tape, for a pass that carries other columns too."""
    def scores(values: pd.DataFrame) -> pd.Series:
        return _scored(forest, 2.0, 0, values.assign(loan_id=None))["score"]

    filled = [F.coalesce(_number(m), F.lit(v)).alias(m) for m, v in zip(forest.metrics, forest.fill)]
    return F.pandas_udf(scores, "double")(F.struct(*filled))


def anomalies(tape: DataFrame, group: str, metrics: Sequence[str], threshold: float = THRESHOLD, robust: float = 3.5) -> DataFrame:
    """Odd loans with reasons; from the robust outlier list (``degraded_mode``) where no forest can be grown."""
    forest = fit(tape, metrics)
    if forest is None:
        return robust_outliers(tape, group, metrics, robust).select(
            "loan_id", F.col("max_abs_z").alias("score"), "reasons", "degraded_mode")
    return score(tape, forest, threshold).where("is_anomaly").select("loan_id", "score", "reasons", "degraded_mode")

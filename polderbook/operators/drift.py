"""Distribution drift between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SERIES_TERMS = 100
# Bins per metric: a power of two, so that an edge search is that many halvings.
_BINS = 512
_ACCURACY = 4_096


def stack_metrics(
    tape: DataFrame, metrics: Sequence[str], keep: Sequence[str] = (), numbered: bool = False
) -> DataFrame:
    """Long form ``metric, value`` without nulls and NaN; ``numbered``: the place in ``metrics`` instead of the name."""
    pairs = F.array(*[
        F.struct(F.lit(i if numbered else m).alias("metric"), F.col(m).cast("double").alias("value"))
        for i, m in enumerate(metrics)
    ])
    long = tape.select(*keep, F.inline(pairs))
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def kolmogorov_tail(scaled: Column) -> Column:
    """Asymptotic two-sided tail probability of the scaled KS statistic."""
    terms = F.sequence(F.lit(1), F.lit(_SERIES_TERMS))
    series = F.aggregate(
        terms,
        F.lit(0.0),
        lambda acc, j: acc
        + F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0))
        * F.exp(F.lit(-2.0) * j * j * scaled * scaled),
    )
    # The series does not converge near zero, where the probability is 1.
    return F.when(scaled < 0.2, F.lit(1.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), series))
    )


def with_bins(counts: DataFrame, bins: int = _BINS) -> DataFrame:
    """Rows ``metric, value, n0, n1`` with an order-preserving ``bin`` of about equally many rows and totals ``t0, t1``.

    Edges are approximate percentiles of the metric's own values, so a column within a hair of
    one number spreads as well as one over many decades; equal values share a bin. One row of
    edges and totals per metric is sent to all tasks; it needs every column of ``counts``, so
    the shuffle that made them serves both sides of the join.
    """
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    edges = counts.groupBy("metric").agg(
        F.percentile_approx("value", shares, _ACCURACY).alias("edges"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    placed = counts.join(F.broadcast(edges), "metric").withColumn("bin", F.lit(0))
    # Halving, one compiled projection per step (a higher-order function is interpreted).
    for half in (2**i for i in reversed(range((bins - 1).bit_length()))):
        at = F.col("bin")
        placed = placed.withColumn("bin", at + F.when(F.col("edges")[at + half - 1] <= F.col("value"), half).otherwise(0))
    return placed.drop("edges")


def ks_drift(before: DataFrame, after: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test per metric: exact statistic, asymptotic p-value.

    1. Counts per distinct value, combined before the shuffle: a value shared by a
       third of the loans is one row.
    2. Values are accumulated within their bin of about equally many distinct values.
       What precedes a bin shifts all its differences alike, so of each bin only the
       largest and the smallest one, and its totals, are kept.
    3. Only these few rows are accumulated in global order.
    """
    sides = stack_metrics(before, metrics, numbered=True).withColumn("old", F.lit(1)).unionByName(
        stack_metrics(after, metrics, numbered=True).withColumn("old", F.lit(0))
    )
    counts = with_bins(
        sides.groupBy("metric", "value").agg(F.sum("old").alias("n0"), F.sum(1 - F.col("old")).alias("n1"))
    )
    inside = Window.partitionBy("metric", "bin").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0
    )
    summed = counts.select(
        "metric", "bin", "t0", "t1", F.sum("n0").over(inside).alias("s0"), F.sum("n1").over(inside).alias("s1"))
    # both shares rise with the value, so a bin's totals are its largest sums
    place = F.struct((F.try_divide(F.col("s0"), F.col("t0")) - F.try_divide(F.col("s1"), F.col("t1"))).alias("ahead"), "s0", "s1")
    bins = summed.groupBy("metric", "bin").agg(
        F.max("s0").alias("b0"), F.max("s1").alias("b1"), F.first("t0").alias("n_before"), F.first("t1").alias("n_after"),
        F.max(place).alias("high"), F.min(place).alias("low"))
    earlier = Window.partitionBy("metric").orderBy("bin").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = bins.select(
        "metric", "n_before", "n_after", "high", "low",
        F.coalesce(F.sum("b0").over(earlier), F.lit(0)).alias("o0"),
        F.coalesce(F.sum("b1").over(earlier), F.lit(0)).alias("o1"),
    )

    def gap(at: str) -> Column:
        return F.abs(
            F.try_divide(F.col("o0") + F.col(f"{at}.s0"), F.col("n_before"))
            - F.try_divide(F.col("o1") + F.col(f"{at}.s1"), F.col("n_after"))
        )

    named = F.element_at(F.array(*[F.lit(m) for m in metrics]), F.col("metric") + 1).alias("metric")
    distance = offsets.groupBy(named).agg(
        F.first("n_before").alias("n_before"), F.first("n_after").alias("n_after"),
        F.max(F.greatest(gap("high"), gap("low"))).alias("ks_statistic"))
    n0, n1 = F.col("n_before").cast("double"), F.col("n_after").cast("double")
    scaled = F.sqrt(F.try_divide(n0 * n1, n0 + n1)) * F.col("ks_statistic")
    return distance.withColumn("p_value", kolmogorov_tail(scaled))

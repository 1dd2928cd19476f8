"""Rule-based anomalies: robust outliers per loan and unusual product mix per vintage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polderbook.functions.bins import order_bin
from polderbook.functions.derived import vintage
from polderbook.operators.drift import stack_metrics
from polderbook.sources.shared import with_known_size

# ---- fixed value: scales a median absolute deviation to a standard deviation ---
MAD_SCALE = 1.4826


def exact_medians(long: DataFrame, keys: Sequence[str], name: str = "median") -> DataFrame:
    """Exact median of ``value`` per key, whatever the size of a group.

    A built-in percentile keeps all values of a group in one buffer. Here bin
    counts (few, combined before the shuffle) locate the bin of the middle ranks,
    and only the values of that bin are then ordered. At most two bins per key are
    looked up.
    """
    keys = list(keys)
    binned = long.withColumn("bin", order_bin(F.col("value")))
    bins = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    placed = bins.select(
        *keys, "bin", "n",
        (F.sum("n").over(order) - F.col("n")).alias("offset"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    ).withColumns(
        {"lo": F.floor((F.col("total") - 1) / 2), "hi": F.floor(F.col("total") / 2)}
    )

    def holds(rank: str, start: str, count: str):
        return (F.col(rank) >= F.col(start)) & (F.col(rank) < F.col(start) + F.col(count))

    middle = with_known_size(
        placed.where(holds("lo", "offset", "n") | holds("hi", "offset", "n")).drop("n", "total")
    )
    values = (
        binned.join(middle, [*keys, "bin"])
        .groupBy(*keys, "bin", "offset", "lo", "hi", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    inside = Window.partitionBy(*keys, "bin").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = values.withColumn(
        "start", F.col("offset") + F.sum("n").over(inside) - F.col("n")
    )
    return ranked.groupBy(*keys).agg(
        (
            (
                F.max(F.when(holds("lo", "start", "n"), F.col("value")))
                + F.max(F.when(holds("hi", "start", "n"), F.col("value")))
            )
            / 2
        ).alias(name)
    )


def robust_outliers(
    tape: DataFrame, group: str, metrics: Sequence[str], threshold: float
) -> DataFrame:
    """Loans whose robust z-score exceeds ``threshold`` on some metric, with the reasons.

    The score is ``(value - median) / (1.4826 * MAD)`` within the group; metrics
    without spread are skipped. ``degraded_mode`` marks the rule-based fallback.
    """
    # Loans without a group are scored against one another.
    tape = tape.withColumn("__group", F.coalesce(F.col(group).cast("string"), F.lit("unknown")))
    keys = ["__group", "metric"]
    long = stack_metrics(tape, metrics, keep=["loan_id", "__group"])
    medians = with_known_size(exact_medians(long.select(*keys, "value"), keys))
    deviations = long.join(medians, keys).select(
        *keys, F.abs(F.col("value") - F.col("median")).alias("value")
    )
    spread = exact_medians(deviations, keys, "mad")
    scales = medians.join(spread, keys).where("mad > 0")
    pivoted = scales.groupBy("__group").agg(*[
        F.max(F.when(F.col("metric") == m, F.col(c))).alias(f"__{c}_{m}")
        for m in metrics for c in ("median", "mad")
    ])
    scored = tape.select("loan_id", group, "__group", *metrics).join(with_known_size(pivoted), "__group")
    z = {
        m: (F.col(m) - F.col(f"__median_{m}")) / (F.col(f"__mad_{m}") * MAD_SCALE)
        for m in metrics
    }
    size = {m: F.coalesce(F.abs(z[m]), F.lit(0.0)) for m in metrics}
    reasons = F.concat_ws(",", *[F.when(size[m] > threshold, F.lit(m)) for m in metrics])
    worst = F.greatest(*size.values()) if len(metrics) > 1 else size[metrics[0]]
    return scored.select(
        "loan_id", group, reasons.alias("reasons"), worst.alias("max_abs_z"),
        F.lit(True).alias("degraded_mode"),
    ).where(F.col("max_abs_z") > threshold)


def repayment_mix_anomaly(
    tape: DataFrame, repayment_type: str = "AFLOSSINGSVRIJ", threshold: float = 2.0
) -> DataFrame:
    """Share of one repayment type per vintage, scored against all other vintages."""
    years = tape.groupBy(vintage().alias("vintage")).agg(
        F.count(F.lit(1)).alias("loan_count"),
        (F.count_if(F.col("repayment_type") == repayment_type) / F.count(F.lit(1))).alias("share"),
    )
    # One row per calendar year, hence a window without a partition key.
    everything = Window.partitionBy()
    n = F.count(F.lit(1)).over(everything)
    # Shares are centred first, so that equal shares have no spread at all.
    centred = years.withColumn("off", F.col("share") - F.avg("share").over(everything))
    total, squares = F.sum("off").over(everything), F.sum(F.col("off") * F.col("off")).over(everything)
    scored = centred.withColumns(
        {
            "others": n - 1,
            "mean_off": F.try_divide(total - F.col("off"), n - 1),
            "squares_others": squares - F.col("off") * F.col("off"),
        }
    ).withColumn("mean_others", F.col("share") - F.col("off") + F.col("mean_off"))
    variance = F.try_divide(
        F.col("squares_others") - F.col("others") * F.col("mean_off") * F.col("mean_off"),
        F.col("others") - 1,
    )
    scored = scored.withColumn("sd_others", F.sqrt(F.greatest(variance, F.lit(0.0))))
    z = F.try_divide(F.col("share") - F.col("mean_others"), F.col("sd_others"))
    return scored.select(
        "vintage", "loan_count", "share", "mean_others", "sd_others", z.alias("z_score"),
        F.coalesce(F.abs(z) > threshold, F.lit(False)).alias("is_anomaly"),
    )

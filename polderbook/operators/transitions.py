"""Arrears migration between two snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from polderbook.model import ARREARS_BUCKETS

_STATES = (*ARREARS_BUCKETS, "unknown")


def roll_rates(before: DataFrame, after: DataFrame) -> DataFrame:
    """Transition matrix of arrears buckets over the loans present in both snapshots.

    Equal to an inner join on ``loan_id`` followed by a count of bucket pairs, but
    both snapshots are stacked and reduced to one small row per loan. The partial
    sums are built before the single shuffle, so an id that repeats without end
    (a corrupt or default key) costs one row per task instead of a join explosion.
    Loans without an id match nothing. Buckets outside the list are reported as ``unknown``.
    """

    def side(tape: DataFrame, is_before: bool) -> DataFrame:
        known = F.col("arrears_bucket").isin(*ARREARS_BUCKETS)
        return tape.where(F.col("loan_id").isNotNull()).select(
            "loan_id",
            F.when(known, F.col("arrears_bucket")).otherwise(F.lit("unknown")).alias("bucket"),
            (F.col("current_balance") if is_before else F.lit(0.0)).alias("balance"),
            F.lit(is_before).alias("is_before"),
        )

    stacked = side(before, True).unionByName(side(after, False))
    old = F.col("is_before")
    here = {s: F.col("bucket") == s for s in _STATES}
    per_loan = stacked.groupBy("loan_id").agg(
        *[F.count_if(old & here[s]).alias(f"n0_{i}") for i, s in enumerate(_STATES)],
        *[F.count_if(~old & here[s]).alias(f"n1_{i}") for i, s in enumerate(_STATES)],
        *[F.sum(F.when(old & here[s], F.col("balance")).otherwise(0.0)).alias(f"b0_{i}")
          for i, s in enumerate(_STATES)],
    )
    sources = F.array(*[
        F.struct(F.lit(s).alias("from_bucket"), F.col(f"n0_{i}").alias("n0"),
                 F.col(f"b0_{i}").alias("b0"))
        for i, s in enumerate(_STATES)
    ])
    targets = F.array(*[
        F.struct(F.lit(s).alias("to_bucket"), F.col(f"n1_{i}").alias("n1"))
        for i, s in enumerate(_STATES)
    ])
    from_rows = per_loan.select(F.inline(sources), targets.alias("targets")).where("n0 > 0")
    pairs = from_rows.select(
        "from_bucket", "n0", "b0", F.inline("targets")
    ).where("n1 > 0")
    matrix = pairs.groupBy("from_bucket", "to_bucket").agg(
        F.sum(F.col("n0") * F.col("n1")).alias("loan_count"),
        F.sum(F.col("b0") * F.col("n1")).alias("exposure"),
    )
    row = Window.partitionBy("from_bucket")
    return matrix.withColumn("roll_rate", F.col("loan_count") / F.sum("loan_count").over(row))

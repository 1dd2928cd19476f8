"""What earlier snapshots of a portfolio add to the present one.

``snapshots`` is a table of tapes one below the other with a snapshot date per row, as a
store partitioned by date gives it. Loans are aggregated before the shuffle, one row per
loan and task, and windows run over the snapshots of one loan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.operators.sicr import ORIGINATION_PD

#: Months after a restructuring during which it counts as forbearance.
FORBEARANCE_MONTHS = 24
#: Days past due from which a loan is in default.
DEFAULT_DAYS = 90


def first_values(
    snapshots: DataFrame, values: Sequence[str], at: str = "snapshot_date", known: DataFrame | None = None
) -> DataFrame:
    """(loan_id, first_seen, values) from the earliest snapshot of each loan.

    ``known``, an earlier result, is merged in, so a new tape costs one pass over that tape and
    the result, not over the history. Where a snapshot repeats a loan, the smallest values count.
    Rows without a loan or a date are left out.
    """
    rows = snapshots.select("loan_id", F.col(at).alias("first_seen"), *values)
    if known is not None:
        rows = rows.unionByName(known.select("loan_id", "first_seen", *values))
    first = F.min(F.struct("first_seen", *values)).alias("first")
    return rows.where("loan_id IS NOT NULL AND first_seen IS NOT NULL").groupBy("loan_id").agg(first).select(
        "loan_id", "first.*")


def with_origination_pd(tape: DataFrame, first: DataFrame) -> DataFrame:
    """The tape with the lifetime PD that a loan had when it was first seen, null if it never was."""
    origin = first.select("loan_id", F.col("pd_lifetime").alias(ORIGINATION_PD))
    return tape.drop(ORIGINATION_PD).join(origin, "loan_id", "left")


def spells(snapshots: DataFrame, holds: Column, at: str = "snapshot_date") -> DataFrame:
    """(loan_id, spell_start, spell_end, snapshots): unbroken runs of snapshots of a loan where ``holds``.

    Gaps and islands over the snapshots the loan appears in; a snapshot that repeats a loan
    counts once, and holds when any of its rows does. A null condition does not hold. ``spell_end`` is
    the last snapshot of the run.
    """
    seen = snapshots.where(F.col("loan_id").isNotNull() & F.col(at).isNotNull()).groupBy("loan_id", F.col(at).alias("seen")).agg(
        F.max(F.coalesce(holds, F.lit(False))).alias("holds"))
    loan = Window.partitionBy("loan_id").orderBy("seen")
    starts = F.col("holds") & ~F.coalesce(F.lag("holds").over(loan), F.lit(False))
    numbered = seen.withColumn("starts", starts.cast("int")).withColumn("spell", F.sum("starts").over(loan)).where("holds")
    return numbered.groupBy("loan_id", "spell").agg(
        F.min("seen").alias("spell_start"), F.max("seen").alias("spell_end"), F.count(F.lit(1)).alias("snapshots")
    ).drop("spell")


def credit_events(snapshots: DataFrame, reference: Column, at: str = "snapshot_date") -> DataFrame:
    """(loan_id, restructure_date, forborne, date_of_default) as of a date, for loans with either event.

    The restructure date is the start of the last restructured spell; a loan is forborne for
    ``FORBEARANCE_MONTHS`` from it. The date of default is the start of the default spell that
    still runs in the loan's last snapshot. Snapshots after ``reference`` do not count.
    """
    past = snapshots.where(F.col(at) <= reference)
    restructured = spells(past, F.col("restructured_flag"), at).groupBy("loan_id").agg(
        F.max("spell_start").alias("restructure_date"))
    in_default = (F.col("days_past_due") >= DEFAULT_DAYS) | F.col("unlikely_to_pay_flag") | (F.col("ifrs9_stage") == "3")
    last_seen = past.groupBy("loan_id").agg(F.max(at).alias("last_seen"))
    running = spells(past, in_default, at).join(last_seen, "loan_id").where(F.col("spell_end") == F.col("last_seen")).select(
        "loan_id", F.col("spell_start").alias("date_of_default"))
    return restructured.join(running, "loan_id", "full").select(
        "loan_id", "restructure_date",
        F.coalesce(reference <= F.add_months("restructure_date", FORBEARANCE_MONTHS), F.lit(False)).alias("forborne"),
        "date_of_default")

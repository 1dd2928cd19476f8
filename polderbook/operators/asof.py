"""As-of join: each row gets the latest reference row at or before its own place.

Both sides are stacked and put in order of group and place by one range partitioning, so a
group of any size spreads over many tasks. A task fills the last reference values forward
within its own stretch; what a stretch begins with comes from a table with one row per
group and stretch, the last reference row of each. No side is broadcast by assumption and
no group is held by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polderbook.sources.shared import with_known_size


def asof_join(
    rows: DataFrame, reference: DataFrame, by: Sequence[str], place: str, values: Sequence[str],
    before_first: str = "null",
) -> DataFrame:
    """``rows`` with the columns ``values`` of the last ``reference`` row in the same group ``by``
    whose ``place`` is not after theirs.

    ``before_first`` says what a row ahead of its group's first reference row gets: ``null``, or
    ``first`` for that first row. Null groups match null groups; rows with a null place get
    nulls. Of reference rows alike in group and place the one with the largest values counts.
    """
    if before_first not in ("null", "first"):
        raise ValueError(f"before_first is 'null' or 'first', not {before_first!r}")
    kind = rows.schema[place].dataType
    carried = F.struct(*[F.col(f"`{v}`") for v in values])
    loans = rows.select(
        *[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], F.col(place).alias("at"), F.lit(1).alias("side"),
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    known = reference.where(F.col(place).isNotNull()).groupBy(*by, place).agg(F.max(carried).alias("known")).select(
        *[F.col(c).alias(f"by_{i}") for i, c in enumerate(by)], F.col(place).cast(kind).alias("at"),
        F.lit(0).alias("side"), "known")
    groups = [f"by_{i}" for i in range(len(by))]
    order = [*groups, "at", "side"]
    stacked = loans.unionByName(known, allowMissingColumns=True)
    placed = with_known_size(
        stacked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
        .withColumn("stretch", F.shiftright("id", 33)))
    so_far = Window.partitionBy("stretch", *groups).orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = placed.withColumn("own", F.last("known", ignorenulls=True).over(so_far)).where("side = 1")
    # one row per stretch and group, whether it has reference rows or not
    ends = placed.groupBy("stretch", *groups).agg(
        F.max_by("known", F.when(F.col("side") == 0, F.col("id"))).alias("last"),
        F.min_by("known", F.when(F.col("side") == 0, F.col("id"))).alias("first"))
    along = Window.partitionBy(*groups).orderBy("stretch")
    stretches = ends.select(
        F.col("stretch").alias("s_stretch"), *[F.col(g).alias(f"s_{g}") for g in groups],
        F.last("last", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
        F.first("first", ignorenulls=True).over(along.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("later"))
    matched = filled.join(
        stretches, (F.col("stretch") == F.col("s_stretch")) & _all(F.col(g).eqNullSafe(F.col(f"s_{g}")) for g in groups), "left")
    found = F.coalesce("own", "earlier", *(["later"] if before_first == "first" else []))
    given = F.when(F.col("at").isNotNull(), found)
    return matched.select(given.alias("given"), "row").select(
        "row.*", *[F.col(f"given.`{v}`").alias(v) for v in values])


def _all(conditions) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out

"""What changed between two tapes, as multisets of rows.

A fingerprint per slice of the key says which slices hold the same rows, however they are
ordered and however often each repeats; only the rows of the other slices are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.sources.shared import with_known_size

#: Slices of the key; a table of this many rows tells which of them differ.
SLICES = 4096


def _slice(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLICES)).cast("int")


def fingerprints(tape: DataFrame, key: str) -> DataFrame:
    """(slice, rows, sum, mix): equal for equal multisets of rows, whatever their order.

    Sums of two independent row hashes; rows are combined before the shuffle, so each task
    sends at most ``SLICES`` rows.
    """
    row = [F.col(f"`{c}`") for c in sorted(tape.columns)]
    # a null is told from any value by its place
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in row])
    first, second = F.xxhash64(*row, nulls), F.xxhash64(nulls, F.lit("second"), *reversed(row))
    return tape.groupBy(_slice(key).alias("slice")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(first.cast("decimal(20,0)")).alias("sum"),
        F.sum(second.cast("decimal(20,0)")).alias("mix"))


def tape_difference(before: DataFrame, after: DataFrame, key: str = "loan_id") -> DataFrame:
    """One row per differing row: the key, ``change``, ``copies`` and ``changed_columns``.

    ``changed``: the key has one row on each side only, equally often, and they differ in the
    columns listed, in order of the tape. Otherwise ``removed`` and ``added``, with the number of
    copies that are gone or new. Null equals null. Both tapes have the same columns; rows with a null key take part.
    """
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the tapes differ in their columns")
    columns = before.columns
    old, new = fingerprints(before, key), fingerprints(after, key)
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in ("rows", "sum", "mix")]
    apart = with_known_size(
        old.alias("o").join(new.alias("n"), F.col("o.slice") == F.col("n.slice"), "full")
        .where(~(same[0] & same[1] & same[2])).select(F.coalesce("o.slice", "n.slice").alias("slice")))

    def side(tape: DataFrame, sign: int) -> DataFrame:
        wanted = tape.select(*columns, _slice(key).alias("slice")).join(apart, "slice", "left_semi").drop("slice")
        return wanted.withColumn("__n", F.lit(sign))

    net = side(before, 1).unionByName(side(after, -1)).groupBy(*columns).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    row = F.struct(*[F.col(f"`{c}`") for c in columns])
    gone, come = F.col("__n") > 0, F.col("__n") < 0
    # a key whose rows differ in one row on each side is one changed loan
    per_key = net.groupBy(key).agg(
        F.count_if(gone).alias("gone"), F.count_if(come).alias("come"), F.sum("__n").alias("rest"),
        F.max(F.when(gone, F.col("__n"))).alias("copies"),
        F.max_by(row, F.when(gone, F.lit(1))).alias("old"), F.max_by(row, F.when(come, F.lit(1))).alias("new"))
    one = (F.col("gone") == 1) & (F.col("come") == 1) & (F.col("rest") == 0)
    listed = F.concat_ws(",", *[
        F.when(~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")), F.lit(c)) for c in columns])
    changed = per_key.where(one).select(key, F.lit("changed").alias("change"), "copies", listed.alias("changed_columns"))
    others = per_key.where(~one).select(F.col(key).alias("__key"))
    rest = net.join(others, F.col(key).eqNullSafe(F.col("__key")), "left_semi").select(
        key, F.when(gone, "removed").otherwise("added").alias("change"), F.abs("__n").alias("copies"),
        F.lit(None).cast("string").alias("changed_columns"))
    return changed.unionByName(rest)

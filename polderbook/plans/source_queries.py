"""Queries over sources, sinks and tapes with a defect in every column.

All start from the tape derived from the test tables: they write it in the form
that a source reads, or spoil one column per loan, and return what comes back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions import derived
from polderbook.model import FIELDS, Field
from polderbook.operators import validation
from polderbook.sources import reader, reference_tables, store
from polderbook.sources.shared import working_folder

#: Loans take turns over four defects of each column: no value, too low or unknown, too high or long, not a number.
TURNS = 4 * len(FIELDS)


def number() -> Column:
    return F.substring("loan_id", 4, 9).cast("long")


def _too_low(field: Field) -> Column | None:
    if field.allowed:
        return F.lit("ONBEKEND")
    if field.pattern is not None:
        return F.lit("12 AB")
    if field.min_len is not None:
        return F.lit("  ")
    return None if field.low is None else F.lit(field.low - 1).cast(field.spark_type)


def _too_high(field: Field) -> Column | None:
    if field.max_len is not None:
        return F.lit("EURO")
    return None if field.high is None else F.lit(field.high + 1).cast(field.spark_type)


def spoiled(tape: DataFrame) -> DataFrame:
    """The payload in which every loan has at most one new defect, by its number."""
    turn, changed = F.col("turn"), []
    for i, field in enumerate(FIELDS):
        odd = F.lit(float("nan")) if field.kind == "double" else None
        value = F.when(turn == i, F.lit(None))
        for step, defect in enumerate((_too_low(field), _too_high(field), odd), 1):
            if defect is not None:
                value = value.when(turn == step * len(FIELDS) + i, defect)
        changed.append(value.otherwise(F.col(field.name)).cast(field.spark_type).alias(field.name))
    return tape.withColumn("turn", number() % TURNS).select(*changed)


def as_text(tape: DataFrame) -> DataFrame:
    """The payload with every column as text; one typed column per loan cannot be read."""
    turn = F.col("turn")
    return tape.withColumn("turn", number() % len(FIELDS)).select(*[
        F.when((turn == i) & F.lit(f.kind not in ("string", "enum")), F.lit("12x")).otherwise(F.col(f.name).cast("string")).alias(f.name)
        for i, f in enumerate(FIELDS)])


def other_columns(tape: DataFrame) -> DataFrame:
    """The payload without a required and an optional column, and with one that the model does not know."""
    return reader.payload(tape).drop("dscr", "watchlist_flag").withColumn("remark", F.lit("new"))


def _violations(tape: DataFrame) -> DataFrame:
    return validation.schema_violations(tape).select("loan_id", "field", "code")


def _in_file_order(tape: DataFrame) -> DataFrame:
    """Range partitioned, so that the order of files and rows is that of the loans."""
    return reader.payload(tape).repartitionByRange("loan_id").sortWithinPartitions("loan_id")


def parquet_strict(tape: DataFrame) -> DataFrame:
    """First issues of a Parquet tape, in file order."""
    path = f"{working_folder(tape.sparkSession, 'strict')}/tape.parquet"
    reader.write_tape_file(_in_file_order(tape), path)
    return reader.load_tape(tape.sparkSession, path, strict=True).issues.select("loan_id", "field", "code")


def csv_strict(tape: DataFrame) -> DataFrame:
    """First issues of a CSV tape, in file order."""
    path = f"{working_folder(tape.sparkSession, 'strict')}/tape.csv"
    _in_file_order(tape).write.option("header", True).option("escape", '"').csv(path)
    return reader.load_tape(tape.sparkSession, path, strict=True).issues.select("loan_id", "field", "code")


def named_tapes(tape: DataFrame) -> DataFrame:
    """Every loan under the name of the tape it was found in; a folder holds a tape per stage and another file."""
    spark, folder = tape.sparkSession, working_folder(tape.sparkSession, "named")
    for stage in ("3", "1", "2"):
        reader.write_tape_file(reader.payload(store.by_stage(tape, stage)), f"{folder}/stage-{stage}.parquet")
    tape.select("loan_id").write.csv(f"{folder}/other.csv")
    names = reader.list_available_tapes(spark, folder)
    read = [reader.load_named_tape(spark, name, folder).select(
        F.lit(place).cast("bigint").alias("place"), F.lit(name).alias("tape"), "loan_id") for place, name in enumerate(names)]
    found = read[0]
    for one in read[1:]:
        found = found.unionByName(one)
    return found


def _stored(tape: DataFrame) -> store.TapeStore:
    shelf = store.TapeStore(tape.sparkSession, working_folder(tape.sparkSession, "store"))
    shelf.write_tape(reader.payload(tape), "tape")
    return shelf


def _published(tape: DataFrame, table: str, value: str, name: str, year: Column, scale: float = 1.0) -> DataFrame:
    """A reference table written and read as CSV, joined to the loans by year."""
    spark = tape.sparkSession
    path = f"{working_folder(spark, 'reference')}/{table}.csv"
    reference_tables.reference_table(spark, table).write.option("header", True).csv(path)
    known = reference_tables.read_reference_csv(spark, path, table)
    return reference_tables.with_year_value(tape.select("loan_id", "origination_date"), year, known, value, name, scale).select(
        "loan_id", name)


QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "violations_all_columns": lambda t: _violations(spoiled(t)),
    "violations_text_tape": lambda t: _violations(as_text(t)),
    "violations_other_columns": lambda t: _violations(other_columns(t)),
    "spoiled_counts": lambda t: validation.validity_counts(spoiled(t)),
    "load_parquet_strict": parquet_strict,
    "load_csv_strict": csv_strict,
    "list_named": named_tapes,
    "store_round_trip": lambda t: _stored(t).read_tape("tape"),
    "store_by_vintage": lambda t: _stored(t).query_by_vintage("tape", date(2015, 1, 1), date(2018, 12, 31)).select(
        "loan_id", "origination_date", "current_balance"),
    "store_by_stage": lambda t: _stored(t).query_by_stage("tape", "2").select("loan_id", "ifrs9_stage", "current_balance"),
    # Years outside the published ones have no value here.
    "reference_nhg": lambda t: _published(t, "nhg_caps", "nhg_cap_eur", "nhg_cap", derived.vintage() - 3),
    "reference_hra": lambda t: _published(t, "hra_rates", "max_hra_rate_pct", "hra_rate", derived.vintage(), 0.01),
}

"""Loading tapes from Parquet or CSV."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polderbook.model import BY_NAME, LABEL_COLUMN
from polderbook.operators.validation import TapePlan, first_issues
from polderbook.sources import csv_records, files
from polderbook.sources.csv_records import BLOCK as _BLOCK, FILE as _FILE, ROW as _ROW

DEFAULT_MAX_ISSUES = 10

@dataclass(frozen=True)
class LoadIssue:
    row_index: int | None
    field: str | None
    message: str


@dataclass(frozen=True)
class LoadResult:
    """A loaded tape; ``issues`` holds at most ``max_issues`` rows (empty when not strict)."""

    tape: DataFrame
    path: str
    issues: DataFrame | None = None

    @property
    def row_count(self) -> int:
        return self.tape.count()

    def issue_list(self) -> list[LoadIssue]:
        if self.issues is None:
            return []
        return [LoadIssue(r["row_index"], r["field"], r["message"]) for r in self.issues.collect()]


def _suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "." + name.rsplit(".", 1)[1].lower() if "." in name else ""


def read_csv(spark: SparkSession, path: str, positions: bool = False) -> DataFrame:
    """All columns as text, names from the header; quotes are doubled inside quoted values.

    ``positions`` adds the file, block and row that ``csv_issues`` reports places from.
    """
    rows = csv_records.read(spark, path)
    return rows if positions else rows.drop(_FILE, _BLOCK, _ROW)


def with_tape_types(raw: DataFrame) -> DataFrame:
    """Known columns in their tape type (null where unreadable), unknown columns untouched."""
    plan = TapePlan(raw, ignore=[c for c in raw.columns if c not in BY_NAME])
    values = {p.field.name: p.value for p in plan.columns}
    return raw.select(*[
        F.expr(values[c]).alias(c) if c in values else F.col(c) for c in raw.columns
    ])


def _parquet_rows(tape: DataFrame) -> DataFrame:
    return tape.select("*", F.col("_metadata.file_path").alias(_FILE),
                       F.col("_metadata.row_index").alias(_ROW))


def parquet_issues(tape: DataFrame, max_issues: int = DEFAULT_MAX_ISSUES) -> DataFrame:
    found = first_issues(_parquet_rows(tape), [_FILE, _ROW], max_issues)
    return found.select(F.col(_ROW).alias("row_index"), "loan_id", "field", "code", "message")


def csv_issues(rows: DataFrame, max_issues: int = DEFAULT_MAX_ISSUES) -> DataFrame:
    """The first violations of ``rows``, read with ``positions``, in file order."""
    order = [_FILE, _BLOCK, _ROW]
    found = first_issues(rows, order, max_issues)
    # A row's number is the rows in earlier blocks of its file plus its rank in its own
    # block; only the blocks of the few issues are ranked.
    blocks = rows.groupBy(_FILE, _BLOCK).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(_FILE, _BLOCK, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy(_FILE, _BLOCK).orderBy(_ROW)
    ranked = rows.select(*order).join(found.select(_FILE, _BLOCK).distinct(), [_FILE, _BLOCK], "left_semi").withColumn(
        "rank", F.row_number().over(within) - 1)
    return found.join(ranked, order).join(before, [_FILE, _BLOCK]).select(
        _FILE, (F.col("before") + F.col("rank")).alias("row_index"), "loan_id", "field", "code", "message"
    ).orderBy(_FILE, "row_index").drop(_FILE)


def load_tape(
    spark: SparkSession, path: str, strict: bool = False, max_issues: int = DEFAULT_MAX_ISSUES
) -> LoadResult:
    """Read a ``.parquet`` or ``.csv`` tape; ``strict`` also reports schema violations.

    Raises ``FileNotFoundError`` for a missing path and ``ValueError`` for another
    suffix. The first ``max_issues`` failing rows in file order are reported, each
    with its first violation and its row number within its file.
    """
    path = str(path)
    if not files.exists(spark, path):
        raise FileNotFoundError(f"{path} not found")
    suffix = _suffix(path)
    if suffix == ".parquet":
        tape = spark.read.parquet(path)
        issues = parquet_issues(tape, max_issues) if strict else None
    elif suffix == ".csv":
        tape = with_tape_types(read_csv(spark, path))
        issues = csv_issues(read_csv(spark, path, positions=True), max_issues) if strict else None
    else:
        raise ValueError(f"Unsupported format {suffix!r}: {path} must end in .parquet or .csv")
    return LoadResult(tape, path, issues)


def list_available_tapes(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names of the Parquet tapes in a folder; empty when it does not exist."""
    return files.names(spark, str(folder), ".parquet")


def load_named_tape(spark: SparkSession, name: str, folder: str) -> DataFrame:
    return load_tape(spark, f"{str(folder).rstrip('/')}/{name}").tape


def write_tape_file(tape: DataFrame, path: str) -> None:
    """Write a tape as Parquet, replacing an earlier one."""
    tape.write.mode("overwrite").parquet(str(path))


def payload(tape: DataFrame) -> DataFrame:
    """The tape without its label column."""
    return tape.drop(LABEL_COLUMN)

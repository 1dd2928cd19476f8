"""Schema validation of a tape in one narrow pass.

Constraints become one SQL expression built from the field table, so a tape of
any size is checked without a shuffle and without Python in the tasks. Typed
Parquet input needs no casts; text input (CSV) is parsed leniently first.

The generated code matters here: a row test over 48 columns easily grows past
the 8,000 bytecodes that the JVM is willing to compile. Tests are therefore
written compactly, nulls fall out of the three-valued logic instead of being
tested one by one, and only failing rows reach the long explanatory expressions.

Order of findings within a row: columns in table order, then unknown columns;
the cross-field invariants are looked at only when every column passes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polderbook.functions import text
from polderbook.functions.opaque import where_computed
from polderbook.model import (
    BY_NAME, COLUMNS, FIELDS, HRA_REGIME_START, HRA_REPAYMENT_TYPES, LABEL_COLUMN, PC6_PATTERN,
    Field,
)

_KIND_WORDS = {
    "string": "string", "double": "number", "int": "integer", "bool": "boolean", "date": "date",
    "enum": "value of the list",
}
_TYPE_CODES = {
    "double": "float_type", "int": "int_type", "bool": "bool_type", "date": "date_type",
    "string": "string_type", "enum": "enum",
}


@dataclass(frozen=True)
class Check:
    """A reason to reject a value; ``bad`` is SQL text that is true for a rejected value."""

    bad: str
    code: str
    message: str


@dataclass(frozen=True)
class ColumnPlan:
    """How one tape column is read: its typed value, when it is fine, and why it is not.

    ``reading`` is the SQL text of a value that is read into a column of its own first; else empty.
    """

    field: Field
    value: str
    ok: tuple[str, ...]
    checks: tuple[Check, ...]
    reading: str = ""


@dataclass(frozen=True)
class Invariant:
    """A cross-field condition; ``holds`` is SQL text with column names in braces."""

    name: str
    holds: str
    message: str


_HRA_TYPE = text.in_list("{repayment_type}", HRA_REPAYMENT_TYPES)

INVARIANTS: tuple[Invariant, ...] = (
    Invariant("currency_is_eur", "{currency} = 'EUR'", "currency must be EUR on a Dutch tape"),
    Invariant("maturity_after_origination", "{maturity_date} > {origination_date}",
              "maturity_date must lie after origination_date"),
    Invariant("pd_lifetime_ge_pd_12m", "{pd_lifetime} >= {pd_12m}",
              "pd_lifetime must not be below pd_12m"),
    Invariant("stage_3_backstop",
              "({ifrs9_stage} <> '3' OR {days_past_due} >= 90 OR {unlikely_to_pay_flag}"
              " OR {restructured_flag})",
              "stage 3 needs 90 days past due, unlikely-to-pay or a restructured loan"),
    Invariant("hra_repayment_type", f"(NOT {{tax_deduction_eligible}} OR {_HRA_TYPE})",
              "tax deduction needs an annuity or linear loan"),
    # The repayment type is tested first and then reports alone.
    Invariant("hra_regime_start",
              f"(NOT {{tax_deduction_eligible}} OR NOT {_HRA_TYPE}"
              f" OR {{origination_date}} >= DATE '{HRA_REGIME_START}')",
              "tax deduction needs an origination date in 2013 or later"),
)


def _typed_value(field: Field, source: T.DataType) -> tuple[str, str | None]:
    """SQL for the column in its target type (null where unreadable) and the code for that case."""
    raw, kind = f"`{field.name}`", field.kind
    target = field.spark_type.simpleString()
    if kind in ("string", "enum"):
        if isinstance(source, T.StringType):
            return (text.strip(raw) if kind == "string" else raw), None
    elif source == field.spark_type:
        return raw, None
    elif isinstance(source, T.StringType):
        parse = {"double": text.text_to_double, "int": text.text_to_int,
                 "bool": text.text_to_bool, "date": text.text_to_date}[kind]
        return parse(raw), _TYPE_CODES[kind].replace("_type", "_parsing")
    elif kind == "double" and isinstance(source, (T.NumericType, T.BooleanType)):
        return f"CAST({raw} AS DOUBLE)", None
    elif kind == "int" and isinstance(source, (T.IntegralType, T.BooleanType)):
        return f"try_cast({raw} AS INT)", "int_parsing"
    elif kind == "int" and isinstance(source, T.NumericType):
        whole = f"CAST({raw} AS DOUBLE)"
        return f"CASE WHEN {whole} % 1 = 0 THEN try_cast({raw} AS INT) END", "int_from_float"
    elif kind == "bool" and isinstance(source, T.NumericType):
        return f"CASE WHEN {raw} = 1 THEN true WHEN {raw} = 0 THEN false END", "bool_parsing"
    elif kind == "date" and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        midnight = f"date_trunc('DAY', {raw}) = {raw}"
        return f"CASE WHEN {midnight} THEN CAST({raw} AS DATE) END", "date_from_datetime_inexact"
    return f"CAST(NULL AS {target})", _TYPE_CODES[kind]


def _bounds(field: Field, value: str) -> tuple[list[str], list[Check]]:
    """Range, length, pattern and domain tests. NaN sorts above every number in Spark."""
    ok: list[str] = []
    checks: list[Check] = []
    suffix = "D" if field.kind == "double" else ""

    def add(holds: str, code: str, message: str) -> None:
        ok.append(holds)
        checks.append(Check(f"NOT ({holds})", code, message))

    if field.high is not None:
        sign, code, words = (
            ("<", "less_than", "less than") if field.high_open
            else ("<=", "less_than_equal", "less than or equal to")
        )
        add(f"{value} {sign} {field.high}{suffix}", code,
            f"Input should be {words} {field.high:g}")
    if field.low is not None:
        holds = f"{value} >= {field.low}{suffix}"
        if field.kind == "double" and field.high is None:
            holds += f" AND NOT isnan({value})"
        add(holds, "greater_than_equal",
            f"Input should be greater than or equal to {field.low:g}")
    if field.min_len is not None:
        add(f"length({value}) >= {field.min_len}", "string_too_short",
            f"String should have at least {field.min_len} character(s)")
    if field.max_len is not None:
        add(f"length({value}) <= {field.max_len}", "string_too_long",
            f"String should have at most {field.max_len} characters")
    if field.pattern is not None:
        add(f"{value} RLIKE {text.quoted(field.pattern)}", "string_pattern_mismatch",
            f"String should match pattern '{field.pattern}'")
    if field.allowed:
        add(text.in_list(value, field.allowed), "enum",
            f"Input should be one of {', '.join(field.allowed)}")
    return ok, checks


def _column_plan(field: Field, source: T.DataType | None, read_first: bool) -> ColumnPlan:
    target = field.spark_type.simpleString()
    if source is None:
        if field.required:
            missing = Check("true", "missing", "Field required")
            return ColumnPlan(field, f"CAST(NULL AS {target})", ("false",), (missing,))
        default = {None: "NULL", False: "false"}.get(field.default) or repr(field.default)
        return ColumnPlan(field, f"CAST({default} AS {target})", (), ())
    raw = f"`{field.name}`"
    value, type_code = _typed_value(field, source)
    reading = value if read_first and value != raw else ""
    if reading:
        value = f"`{field.name} as read`"
    ok, checks = _bounds(field, value)
    message = f"Input should be a valid {_KIND_WORDS[field.kind]}"
    if type_code:
        unreadable = f"{raw} IS NOT NULL AND ({value}) IS NULL"
        checks.insert(0, Check(unreadable, type_code, message))
        if field.nullable:
            ok.insert(0, f"NOT ({unreadable})")
    if not field.nullable:
        checks.insert(0, Check(f"{raw} IS NULL", _TYPE_CODES[field.kind], message))
        if not ok:  # nothing else makes a null or unreadable value fail
            ok.append(f"({value}) IS NOT NULL")
    return ColumnPlan(field, value, tuple(ok), tuple(checks), reading)


class TapePlan:
    """Typed values and checks of every column of ``tape``, decided from its schema alone.

    With ``read_first`` they are those of the rows that ``read`` returns, in which every
    value that must be parsed is a column, parsed once for all its tests.
    """

    def __init__(self, tape: DataFrame, ignore: Iterable[str] = (), read_first: bool = False) -> None:
        self.ignored = [c for c in ignore if c in tape.columns]
        skip = {*self.ignored, LABEL_COLUMN}
        source = {f.name: f.dataType for f in tape.schema.fields}
        self.columns = [_column_plan(f, source.get(f.name), read_first) for f in FIELDS]
        self.values = {p.field.name: f"({p.value})" for p in self.columns}
        self.unknown = [c for c in tape.columns if c not in BY_NAME and c not in skip]
        self.labelled = LABEL_COLUMN in tape.columns
        self._fields = [] if not self.unknown else ["false"]
        for plan in self.columns:
            self._fields += plan.ok
        self._cross = [i.holds.format(**self.values) for i in INVARIANTS]

    def read(self, tape: DataFrame) -> DataFrame:
        return tape.select("*", *[F.expr(p.reading).alias(f"{p.field.name} as read") for p in self.columns if p.reading])

    def _all(self, conditions: list[str]) -> Column:
        if "false" in conditions:
            return F.lit(False)
        return F.expr(" AND ".join(conditions))

    @property
    def keep(self) -> Column:
        """Filter condition for valid rows: true, false or (for nulls) null."""
        return self._all(self._fields + self._cross)

    @property
    def row_ok(self) -> Column:
        """Validity as a flag that is never null.

        Null-safe equality also keeps the optimizer from rewriting the negation of
        the flag into dozens of negated tests, which can take it minutes.
        """
        return self.keep.eqNullSafe(F.lit(True))

    @property
    def fields_ok(self) -> Column:
        return self._all(self._fields).eqNullSafe(F.lit(True))

    def selection(self) -> list[Column]:
        """Typed payload columns with defaults, then the label and bookkeeping columns."""
        kept = [
            F.col(p.field.name) if p.value == f"`{p.field.name}`"
            else F.expr(p.value).alias(p.field.name)
            for p in self.columns
        ]
        if self.labelled:
            kept.append(F.col(LABEL_COLUMN))
        return kept + [F.col(c) for c in self.ignored]

    def field_problems(self) -> str:
        """SQL list of one nullable ``(field, code, message)`` struct per column."""
        found = []
        for plan in self.columns:
            if plan.checks:
                branches = " ".join(
                    f"WHEN {c.bad} THEN {_violation(plan.field.name, c.code, c.message)}"
                    for c in plan.checks
                )
                found.append(f"CASE {branches} END")
        found += [_violation(c, "extra_forbidden", "Extra inputs are not permitted")
                  for c in self.unknown]
        return ", ".join(found)

    def cross_problems(self) -> str:
        return ", ".join(
            f"CASE WHEN NOT ({holds}) THEN "
            f"{_violation(None, i.name, 'Value error, ' + i.message)} END"
            for i, holds in zip(INVARIANTS, self._cross)
        )


def _violation(field: str | None, code: str, message: str) -> str:
    name = "CAST(NULL AS STRING)" if field is None else text.quoted(field)
    return (f"named_struct('field', {name}, 'code', {text.quoted(code)}, "
            f"'message', {text.quoted(message)})")


def typed_tape(tape: DataFrame, ignore: Iterable[str] = ()) -> DataFrame:
    """All payload columns in canonical order and type; unreadable values become null."""
    return tape.select(*TapePlan(tape, ignore).selection())


def valid_loans(tape: DataFrame, ignore: Iterable[str] = ()) -> DataFrame:
    """The typed rows that satisfy every constraint.

    The filter sits below the projection on the source columns, so simple bounds
    reach the Parquet reader.
    """
    plan = TapePlan(tape, ignore)
    return tape.where(plan.keep).select(*plan.selection())


def with_validity(tape: DataFrame, flag: str = "is_valid", ignore: Iterable[str] = ()) -> DataFrame:
    """The typed tape with a boolean validity column."""
    plan = TapePlan(tape, ignore)
    return tape.select(*plan.selection(), plan.row_ok.alias(flag))


def validity_counts(tape: DataFrame, ignore: Iterable[str] = ()) -> DataFrame:
    """One row: total, valid and skipped rows."""
    ok = TapePlan(tape, ignore).row_ok
    return tape.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(ok).alias("valid_count")
    ).withColumn("skipped_count", F.col("row_count") - F.col("valid_count"))


def _failing_rows(tape: DataFrame, ignore: Iterable[str]) -> tuple[TapePlan, DataFrame]:
    plan = TapePlan(tape, ignore, read_first=True)
    return plan, where_computed(plan.read(tape), ~plan.row_ok)


def schema_violations(
    tape: DataFrame, row_index: str | None = None, ignore: Iterable[str] = ()
) -> DataFrame:
    """Every violation: ``row_index, loan_id, field, code, message`` (field is null across fields).

    Rows are filtered by the cheap validity test first, so only failing rows pay
    for the per-column explanation.
    """
    ignore = [*ignore, *([row_index] if row_index else [])]
    plan, failing = _failing_rows(tape, ignore)
    index = F.col(row_index).cast("long") if row_index else F.lit(None).cast("long")
    return (
        failing.select(
            index.alias("row_index"),
            F.expr(plan.values["loan_id"]).alias("loan_id"),
            # Never empty; the outer form just adds no derived filter on the array.
            F.explode_outer(
                F.when(plan.fields_ok, F.expr(f"array({plan.cross_problems()})")).otherwise(
                    F.expr(f"array({plan.field_problems()})")
                )
            ).alias("v"),
        )
        .where(F.col("v").isNotNull())
        .select("row_index", "loan_id", "v.field", "v.code", "v.message")
    )


def first_issues(
    tape: DataFrame, order_by: list[str], max_issues: int = 10, ignore: Iterable[str] = ()
) -> DataFrame:
    """First violation of each of the first ``max_issues`` failing rows (at least one).

    A bounded top-n: each task keeps ``max_issues`` rows, nothing is sorted in full.
    """
    ignore = list(dict.fromkeys([*ignore, *(c for c in order_by if c not in BY_NAME)]))
    plan, failing = _failing_rows(tape, ignore)
    keys = {f"__order_{i}": F.col(c) for i, c in enumerate(order_by)}
    # The row limit comes first; only the surviving rows are explained.
    head = failing.withColumns(keys).orderBy(*keys).limit(max(1, max_issues))
    return head.select(
        *[F.col(k).alias(c) for k, c in zip(keys, order_by)],
        *([] if "loan_id" in order_by else [F.expr(plan.values["loan_id"]).alias("loan_id")]),
        F.expr(f"coalesce({plan.field_problems()}, {plan.cross_problems()})").alias("v"),
    ).select("*", "v.field", "v.code", "v.message").drop("v")


def validate_tape(tape: DataFrame, ignore: Iterable[str] = ()) -> int:
    """Number of rows when all are valid; raises ``ValueError`` otherwise."""
    counts = validity_counts(tape, ignore).first()
    if counts["skipped_count"]:
        raise ValueError(
            f"{counts['skipped_count']} of {counts['row_count']} rows violate the tape schema"
        )
    return counts["row_count"]


__all__ = [
    "COLUMNS", "INVARIANTS", "TapePlan", "first_issues", "schema_violations", "typed_tape",
    "valid_loans", "validate_tape", "validity_counts", "with_validity",
]

"""Regulatory cross-field rules as a registry of Column predicates.

All rules are evaluated in one narrow pass. ``gated=True`` (the default) looks
only at schema-valid loans; three of the rules repeat a schema invariant and can
then never fire, so ``gated=False`` evaluates every readable row as well.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import as_date, calendar_months, original_lti
from polderbook.functions.opaque import opaque
from polderbook.functions.text import quoted
from polderbook.model import BY_NAME, HRA_REGIME_START, HRA_REPAYMENT_TYPES
from polderbook.operators.validation import typed_tape, valid_loans

SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
DIMENSIONS = ("accuracy", "completeness", "timeliness", "integrity")

# ---- fixed values: rule thresholds ------------------------------------------
AMORTIZATION_TOLERANCE = 1.001
LTV_TOLERANCE = 0.005
MAX_VALUATION_MONTHS_STAGE_1 = 36
LTI_HARD_CAP = 6.0
INTEREST_ONLY_CAP_RATIO = 0.5

STORED_LTV = "current_ltv"


@dataclass(frozen=True)
class RuleContext:
    """What a rule may depend on besides the loan itself."""

    reference_date: Column
    stored_ltv: bool = False


Expression = Column | Callable[[RuleContext], Column]


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    dimension: str
    regulation: str
    fails: Expression
    message: Expression

    def failed(self, context: RuleContext) -> Column:
        """True where the loan breaks the rule, never null."""
        fails = self.fails(context) if callable(self.fails) else self.fails
        return F.coalesce(fails, F.lit(False))

    def text(self, context: RuleContext) -> Column:
        return self.message(context) if callable(self.message) else self.message


def _c(name: str) -> Column:
    return F.col(name)


def _amount(col: Column) -> Column:
    return F.format_number(col, 0)


def _day(col: Column) -> Column:
    return col.cast("string")


def _has_backstop() -> Column:
    return (_c("days_past_due") >= 90) | _c("unlikely_to_pay_flag") | _c("restructured_flag")


def _ltv_gap(context: RuleContext) -> Column:
    value = _c("property_value_current")
    if not context.stored_ltv:
        return value == 0
    derived = _c("current_balance") / F.nullif(value, F.lit(0.0))
    return (value == 0) | (F.abs(derived - _c(STORED_LTV)) > LTV_TOLERANCE)


def _ltv_text(context: RuleContext) -> Column:
    undefined = F.lit("no LTV: the current property value is zero")
    if not context.stored_ltv:
        return undefined
    value = _c("property_value_current")
    derived = _c("current_balance") / F.nullif(value, F.lit(0.0))
    return F.when(value == 0, undefined).otherwise(
        F.format_string(
            f"stored LTV %.4f, but balance over value gives %.4f (allowed gap {LTV_TOLERANCE})",
            _c(STORED_LTV), derived,
        )
    )


def _valuation_age(context: RuleContext) -> Column:
    return calendar_months(_c("taxatie_date"), context.reference_date)


def _interest_only_cap() -> Column:
    return _c("property_value_at_origination") * INTEREST_ONLY_CAP_RATIO


# Rule names, severities, dimensions, thresholds and citations are fixed values:
# downstream reports key on them.
_BUILT_IN = (
    Rule(
        "negative_amortization", "CRITICAL", "integrity", "Schema integrity (internal)",
        lambda ctx: _c("current_balance") > _c("original_principal") * AMORTIZATION_TOLERANCE,
        lambda ctx: F.format_string(
            "balance %s is more than 0.1%% above the principal %s",
            _amount(_c("current_balance")), _amount(_c("original_principal")),
        ),
    ),
    Rule(
        "stage_3_backstop", "CRITICAL", "integrity", "IFRS 9 par. 5.5.11",
        lambda ctx: (_c("ifrs9_stage") == "3") & ~_has_backstop(),
        lambda ctx: F.lit(
            "in stage 3 without 90 days of arrears, unlikely-to-pay flag or restructuring"
        ),
    ),
    Rule(
        "nhg_cap", "CRITICAL", "integrity", "NHG / WEW annual cap",
        lambda ctx: _c("nhg_flag") & (_c("original_principal") > _c("nhg_cap_at_origination")),
        lambda ctx: F.format_string(
            "guaranteed under NHG, but the principal %s is above the cap %s",
            _amount(_c("original_principal")), _amount(_c("nhg_cap_at_origination")),
        ),
    ),
    Rule(
        "hra_eligibility", "HIGH", "integrity",
        "Hypotheekrenteaftrek regime (Belastingdienst), post-2013",
        lambda ctx: _c("tax_deduction_eligible")
        & (
            ~_c("repayment_type").isin(*HRA_REPAYMENT_TYPES)
            | (_c("origination_date") < F.lit(HRA_REGIME_START))
        ),
        lambda ctx: F.format_string(
            "deducts interest, which repayment type %s with a start on %s does not allow",
            _c("repayment_type"), _day(_c("origination_date")),
        ),
    ),
    Rule(
        "ltv_consistency", "HIGH", "accuracy", "BCBS 239 (data accuracy)", _ltv_gap, _ltv_text,
    ),
    Rule(
        "pd_monotonicity", "HIGH", "integrity", "Survival-analysis monotonicity",
        lambda ctx: _c("pd_lifetime") < _c("pd_12m"),
        lambda ctx: F.concat(
            F.lit("12-month PD "), _c("pd_12m").cast("string"),
            F.lit(" is above the lifetime PD "), _c("pd_lifetime").cast("string"),
        ),
    ),
    Rule(
        "taxatie_freshness", "MEDIUM", "timeliness",
        "BCBS 239 (timeliness) + CRR III collateral valuation",
        lambda ctx: (_c("ifrs9_stage") == "1")
        & (_valuation_age(ctx) > MAX_VALUATION_MONTHS_STAGE_1),
        lambda ctx: F.format_string(
            "last valued on %s, %d months ago; stage 1 allows "
            f"{MAX_VALUATION_MONTHS_STAGE_1}",
            _day(_c("taxatie_date")), _valuation_age(ctx),
        ),
    ),
    Rule(
        "lti_cap", "HIGH", "integrity",
        "Tijdelijke regeling hypothecair krediet (Min. Fin. + AFM) + Nibud",
        lambda ctx: original_lti() > LTI_HARD_CAP,
        lambda ctx: F.format_string(
            f"borrowed %.2f times the income, limit {LTI_HARD_CAP}",
            original_lti(),
        ),
    ),
    Rule(
        "interest_only_cap", "HIGH", "integrity",
        "Hypotheekrenteaftrek regime (Belastingdienst) interest-only cap",
        lambda ctx: _c("tax_deduction_eligible")
        & (_c("interest_only_portion") > _interest_only_cap()),
        lambda ctx: F.format_string(
            "interest-only part %s is above its limit of %s",
            _amount(_c("interest_only_portion")), _amount(_interest_only_cap()),
        ),
    ),
)

RULES: dict[str, Rule] = {rule.name: rule for rule in _BUILT_IN}


def register_rule(
    name: str, predicate: Expression, severity: str, dimension: str, regulation: str,
    message: Expression,
) -> Rule:
    """Add a rule; ``predicate`` is true where a loan breaks it.

    Predicate and message are Columns over the tape, or functions of a
    ``RuleContext`` when they need the reference date.
    """
    if severity not in SEVERITIES:
        raise ValueError(f"severity must be one of {SEVERITIES}, got {severity!r}")
    if dimension not in DIMENSIONS:
        raise ValueError(f"dimension must be one of {DIMENSIONS}, got {dimension!r}")
    RULES[name] = Rule(name, severity, dimension, regulation, predicate, message)
    return RULES[name]


def unregister_rule(name: str) -> None:
    RULES.pop(name, None)


def rule_positions(rules: Mapping[str, Rule] | None = None) -> dict[str, int]:
    return {name: i for i, name in enumerate(RULES if rules is None else rules)}


def scoped_loans(
    tape: DataFrame, reference_date: date | Column | None, gated: bool
) -> tuple[DataFrame, RuleContext]:
    """The rows rules look at: schema-valid ones, or every row with readable values."""
    if gated:
        return valid_loans(tape), RuleContext(as_date(reference_date))
    stored = STORED_LTV in tape.columns and STORED_LTV not in BY_NAME
    rows = typed_tape(tape, ignore=[STORED_LTV] if stored else [])
    return rows, RuleContext(as_date(reference_date), stored)


def rule_flags(
    tape: DataFrame,
    reference_date: date | Column | None = None,
    gated: bool = True,
    rules: Mapping[str, Rule] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per loan with a boolean per rule, true where the rule fails (no shuffle)."""
    rules = RULES if rules is None else rules
    rows, context = scoped_loans(tape, reference_date, gated)
    return rows.select(
        "loan_id", *keep, *[rule.failed(context).alias(name) for name, rule in rules.items()]
    )


def run_all_rules(
    tape: DataFrame,
    reference_date: date | Column | None = None,
    gated: bool = True,
    rules: Mapping[str, Rule] | None = None,
    include_passes: bool = False,
) -> DataFrame:
    """Findings ``loan_id, rule_name, severity, regulation, bcbs239_dimension, message, passed``.

    Failures only, unless ``include_passes``. Loans without a finding are dropped
    before the fan-out, so the output grows with the failures, not with the tape.
    """
    rules = RULES if rules is None else rules
    rows, context = scoped_loans(tape, reference_date, gated)
    failed = [rule.failed(context) for rule in rules.values()]
    entries = []
    for i, (rule, fails) in enumerate(zip(rules.values(), failed), start=1):
        text = rule.text(context)
        if include_passes:
            text = F.when(fails, text).otherwise(F.lit("OK"))
        entry = F.struct(F.lit(i).alias("rule"), text.alias("message"), (~fails).alias("passed"))
        entries.append(entry if include_passes else F.when(fails, entry))
    if not include_passes:
        rows = rows.where(opaque(reduce(or_, failed)))
    found = rows.select("loan_id", F.explode_outer(F.array(*entries)).alias("f"))
    if not include_passes:
        found = found.where(F.col("f").isNotNull())

    def attribute(name: str) -> Column:
        # Constant per rule: looked up after the fan-out instead of copied through it.
        values = ", ".join(quoted(getattr(rule, name)) for rule in rules.values())
        return F.expr(f"element_at(array({values}), f.rule)")

    severity = attribute("severity")
    if include_passes:
        severity = F.when(F.col("f.passed"), F.lit("LOW")).otherwise(severity)
    return found.select(
        "loan_id",
        attribute("name").alias("rule_name"),
        severity.alias("severity"),
        attribute("regulation").alias("regulation"),
        attribute("dimension").alias("bcbs239_dimension"),
        "f.message",
        "f.passed",
    )


def run_rule(
    tape: DataFrame, name: str, reference_date: date | Column | None = None, gated: bool = True,
    include_passes: bool = False,
) -> DataFrame:
    """Findings of a single rule; with ``include_passes`` one row per loan."""
    return run_all_rules(tape, reference_date, gated, {name: RULES[name]}, include_passes)


def rule_counts(
    tape: DataFrame,
    reference_date: date | Column | None = None,
    gated: bool = True,
    rules: Mapping[str, Rule] | None = None,
) -> DataFrame:
    """Loans checked and failed per rule, with severity and dimension.

    Counts come from one global aggregate over the flags: each task ships a
    single row, whatever the number of findings.
    """
    rules = RULES if rules is None else rules
    rows, context = scoped_loans(tape, reference_date, gated)
    totals = rows.agg(
        F.count(F.lit(1)).alias("loans"),
        *[F.count_if(rule.failed(context)).alias(name) for name, rule in rules.items()],
    )
    lines = [
        F.struct(
            F.lit(i).alias("rule_position"),
            F.lit(name).alias("rule_name"),
            F.lit(rule.severity).alias("severity"),
            F.lit(rule.dimension).alias("bcbs239_dimension"),
            F.col("loans").alias("loan_count"),
            F.col(name).alias("failed_count"),
        )
        for i, (name, rule) in enumerate(rules.items())
    ]
    return totals.select(F.inline(F.array(*lines)))


def findings_at(findings: DataFrame, severity: str) -> DataFrame:
    return findings.where(F.col("severity") == severity)


def flagged_loans(tape: DataFrame, findings: DataFrame, rule_name: str) -> DataFrame:
    """Tape rows that appear in ``findings`` under ``rule_name`` (a semi join on the loan id)."""
    hits = findings.where(F.col("rule_name") == rule_name).select("loan_id")
    return tape.join(hits, "loan_id", "left_semi")

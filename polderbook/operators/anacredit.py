"""AnaCredit attribute mapping (Regulation (EU) 2016/867, Annex II) and its conformance check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polderbook.functions.derived import (
    as_date, calendar_months, current_ltv, expected_loss, ltv_at_origination,
)
from polderbook.operators.validation import TapePlan, valid_loans

# ---- fixed values: attributes that must be populated ------------------------
REQUIRED_ATTRIBUTES = (
    "contract_identifier",
    "counterparty_identifier",
    "inception_date",
    "legal_final_maturity_date",
    "currency",
    "outstanding_nominal_amount",
    "commitment_amount_at_inception",
    "type_of_instrument",
    "type_of_interest_rate",
    "interest_rate",
    "performing_status",
    "default_status_of_instrument",
    "type_of_protection",
    "protection_value",
    "protection_valuation_date",
    "real_estate_postal_code",
    "real_estate_country",
    "accounting_classification_ifrs9_stage",
)

# ---- fixed values: allowed enumerations --------------------------------------
ALLOWED_VALUES: dict[str, tuple[str, ...]] = {
    "currency": ("EUR",),
    "type_of_instrument": ("Mortgage loan",),
    "type_of_interest_rate": ("Fixed", "Variable"),
    "performing_status": ("Performing", "Non-performing"),
    "default_status_of_instrument": ("Default", "Not in default"),
    "forbearance_status": ("Forborne", "Not forborne"),
    "type_of_protection_value": ("Market value", "Notional amount", "Other"),
    "real_estate_country": ("NL",),
    "accounting_classification_ifrs9_stage": ("Stage 1", "Stage 2", "Stage 3"),
}

# ---- fixed values: code lists -------------------------------------------------
VALUATION_KINDS = {
    "MARKETVALUE": "Market value",
    "EXECUTIEWAARDE": "Notional amount",
    "MODELMATIG": "Other",
}


def _either(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def _recode(col: Column, codes: Mapping[str, str]) -> Column:
    """A null for values outside the code list."""
    chain = F
    for source, target in codes.items():
        chain = chain.when(col == source, F.lit(target))
    return chain


def _attributes() -> dict[str, Column]:
    c = F.col
    stage = c("ifrs9_stage")
    impaired = stage == "3"
    non_performing = (
        impaired
        | (c("days_past_due") >= 90)
        | c("unlikely_to_pay_flag")
        | (c("arrears_bucket") == "90+")
    )
    return {
        "contract_identifier": c("loan_id"),
        "inception_date": c("origination_date"),
        "settlement_date": c("origination_date"),
        "legal_final_maturity_date": c("maturity_date"),
        "currency": c("currency"),
        "commitment_amount_at_inception": c("original_principal"),
        "type_of_instrument": F.lit("Mortgage loan"),
        "type_of_interest_rate": _either(c("rate_type") == "VARIABEL", "Variable", "Fixed"),
        "interest_rate": c("interest_rate"),
        "project_finance_loan": F.lit(False),
        "ltv_at_origination": F.round(ltv_at_origination(), 6),
        "counterparty_identifier": c("borrower_id"),
        "outstanding_nominal_amount": c("current_balance"),
        "performing_status": _either(non_performing, "Non-performing", "Performing"),
        "default_status_of_instrument": _either(impaired, "Default", "Not in default"),
        "forbearance_status": _either(c("restructured_flag"), "Forborne", "Not forborne"),
        "current_ltv": current_ltv(),
        "pd_12m": c("pd_12m"),
        "pd_lifetime": c("pd_lifetime"),
        "lgd": c("lgd"),
        "ead": c("ead"),
        "risk_weight": c("risk_weight"),
        "type_of_protection": _either(
            c("nhg_flag"), "Residential real estate + NHG guarantee", "Residential real estate"
        ),
        "protection_value": c("taxatie_waarde"),
        "type_of_protection_value": _recode(c("taxatie_type"), VALUATION_KINDS),
        "protection_valuation_date": c("taxatie_date"),
        "real_estate_postal_code": c("pc6"),
        "real_estate_country": F.lit("NL"),
        "real_estate_construction_year": c("bouwjaar"),
        "energy_performance_certificate": c("energy_label"),
        "accounting_classification_ifrs9_stage": F.concat(F.lit("Stage "), stage),
        "accumulated_impairment_amount": F.round(expected_loss(), 2),
    }


def attribute_expressions() -> list[Column]:
    return [expr.alias(name) for name, expr in _attributes().items()]


def _checked_rows(tape: DataFrame, on_invalid: str, extra: Sequence[str] = ()) -> DataFrame:
    """Valid rows, with the columns ``extra`` that are not part of the schema."""
    if on_invalid == "skip":
        return valid_loans(tape, ignore=list(extra))
    if on_invalid != "raise":
        raise ValueError(f"on_invalid must be 'raise' or 'skip', got {on_invalid!r}")
    plan = TapePlan(tape.drop(*extra))
    stop = F.raise_error(F.lit("tape row violates the loan schema")).cast("boolean")
    return tape.where(F.when(plan.row_ok, F.lit(True)).otherwise(stop)).select(*plan.selection(), *extra)


def map_tape(tape: DataFrame, on_invalid: str = "raise") -> DataFrame:
    """The 32-attribute table, one row per loan.

    A schema-invalid row stops the job (``raise``) or is left out (``skip``).
    """
    return _checked_rows(tape, on_invalid).select(*attribute_expressions())


def check_conformance(
    attributes: DataFrame,
    required: Sequence[str] = REQUIRED_ATTRIBUTES,
    allowed: Mapping[str, Sequence[str]] = ALLOWED_VALUES,
) -> DataFrame:
    """Populated and enumerated checks on any attribute table, also an edited or partial one.

    ``missing_attributes`` and ``invalid_values`` list names in declaration order.
    """
    columns = set(attributes.columns)

    def listed(flags: list[Column]) -> Column:
        return F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>")

    missing = []
    for name in required:
        if name not in columns:
            missing.append(F.lit(name))
            continue
        value = F.col(name)
        empty = value.isNull() | (value.cast("string") == "")
        missing.append(F.when(empty, F.lit(name)))
    invalid = []
    for name, values in allowed.items():
        if name in columns:
            value = F.col(name)
            text = F.format_string(
                f"{name} is '%s', known are: %s",
                value, F.lit(", ".join(sorted(values))),
            )
            invalid.append(F.when(~value.isin(*values), text))
    populated = _all_null(missing)
    enumerated = _all_null(invalid)
    loan_id = F.col("contract_identifier") if "contract_identifier" in columns else F.lit(None)
    nothing = F.array().cast("array<string>")
    return attributes.select(
        loan_id.cast("string").alias("loan_id"),
        populated.alias("populated"),
        enumerated.alias("enumerated"),
        # The lists are built only for the rows that have something to list.
        F.when(populated, nothing).otherwise(listed(missing)).alias("missing_attributes"),
        F.when(enumerated, nothing).otherwise(listed(invalid)).alias("invalid_values"),
        (populated & enumerated).alias("conforming"),
    )


def _all_null(flags: list[Column]) -> Column:
    return F.coalesce(*flags).isNull() if flags else F.lit(True)


def portfolio_conformance(tape: DataFrame) -> DataFrame:
    """One row: valid loans, conforming loans and their share (0.0 when there are none)."""
    return conformance_share(check_conformance(map_tape(tape, on_invalid="skip")))


def conformance_share(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count(F.lit(1)).alias("loan_count"), F.count_if("conforming").alias("conforming_count")
    ).withColumn(
        "conformance_share",
        F.when(F.col("loan_count") == 0, F.lit(0.0)).otherwise(
            F.col("conforming_count") / F.col("loan_count")
        ),
    )


FORBEARANCE_WINDOW_MONTHS = 24


def map_tape_extended(
    tape: DataFrame, reference_date: date | Column | None = None, on_invalid: str = "skip"
) -> DataFrame:
    """Attributes of the crosswalk that the base mapping leaves out, keyed by contract.

    Repayment rights and the default date have no published source field and stay
    null. A ``restructured_date`` column, where the tape has one, limits the
    forbearance status to 24 months; without it the flag alone decides.
    """
    extra = ["restructured_date"] if "restructured_date" in tape.columns else []
    rows = _checked_rows(tape, on_invalid, extra)
    reference = as_date(reference_date)
    forborne = F.col("restructured_flag")
    if extra:
        age = calendar_months(F.col("restructured_date"), reference)
        forborne = forborne & F.coalesce(age <= FORBEARANCE_WINDOW_MONTHS, F.lit(True))
    return rows.select(
        F.col("loan_id").alias("contract_identifier"),
        reference.alias("reference_date"),
        _either(F.col("rate_type") == "VARIABEL", "Continuous", "At rentevast end").alias(
            "interest_rate_reset_frequency"
        ),
        F.lit(None).cast("string").alias("repayment_rights"),
        F.lit("Not securitised").alias("type_of_securitisation"),
        F.lit("Not encumbered").alias("sources_of_encumbrance"),
        F.lit(None).cast("date").alias("date_of_default_status"),
        _either(forborne, "Forborne", "Not forborne").alias("forbearance_renegotiation_status"),
        F.when(F.col("energy_label") == "A++++", F.lit("A+++"))
        .otherwise(F.col("energy_label"))
        .alias("energy_performance_certificate_capped"),
    )


def counterparty_default_status(tape: DataFrame) -> DataFrame:
    """``loan_id, borrower_id, default_status_of_counterparty``.

    A borrower is in default when any of their loans is. Defaulted borrowers are
    reduced to distinct ids on the map side first, so a borrower with very many
    loans costs one row there, and AQE splits their loans on the other side of
    the join; a window per borrower would put them all in one task. A loan without a
    borrower stands for itself.
    """
    in_default = (
        tape.where(F.col("ifrs9_stage") == "3")
        .where(F.col("borrower_id").isNotNull())
        .select("borrower_id")
        .distinct()
        .withColumn("any_default", F.lit(True))
    )
    own = tape.select("loan_id", "borrower_id", (F.col("borrower_id").isNull() & (F.col("ifrs9_stage") == "3")).alias("alone"))
    return own.join(in_default, "borrower_id", "left").select(
        "loan_id",
        "borrower_id",
        _either(F.coalesce("any_default", "alone", F.lit(False)), "Default", "Not in default").alias(
            "default_status_of_counterparty"
        ),
    )

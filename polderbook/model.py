"""The loan record: columns, types, domains and bounds.

One table of ``Field`` rows drives typing, defaults, validation and the Spark
schema, in the order in which violations are reported.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import types as T

LABEL_COLUMN = "easter_egg"

# ---- fixed values: category domains -----------------------------------------
RATE_TYPES = ("VARIABEL", "RENTEVAST_5J", "RENTEVAST_10J", "RENTEVAST_20J", "RENTEVAST_30J")
REPAYMENT_TYPES = (
    "ANNUITEIT", "LINEAIR", "AFLOSSINGSVRIJ", "BANKSPAAR", "SPAAR", "BELEGGING", "HYBRIDE",
)
PROPERTY_TYPES = ("APPARTEMENT", "TUSSENWONING", "HOEKWONING", "2-ONDER-1-KAP", "VRIJSTAAND")
BORROWER_TYPES = ("STARTER", "DOORSTROMER", "OUDERE")
VALUATION_TYPES = ("MARKETVALUE", "EXECUTIEWAARDE", "MODELMATIG")
ENERGY_LABELS = ("A++++", "A+++", "A++", "A+", "A", "B", "C", "D", "E", "F", "G")
SCORE_BANDS = ("A", "B", "C", "D", "E")
STAGES = ("1", "2", "3")
ARREARS_BUCKETS = ("0", "1-30", "31-60", "61-90", "90+")
SICR_REASONS = (
    "NONE", "QUANT_PD_INCREASE", "DPD_30_BACKSTOP", "FORBEARANCE", "WATCHLIST",
    "MACRO_OVERLAY", "CLIMATE_TRANSITION",
)
# ---- fixed values: regulatory constants -------------------------------------
HRA_REPAYMENT_TYPES = ("ANNUITEIT", "LINEAIR")
HRA_REGIME_START = date(2013, 1, 1)
MAX_HRA_RATE = 0.55
PC6_PATTERN = "^[0-9]{4}[A-Z]{2}$"

_SPARK_TYPES = {
    "string": T.StringType(),
    "enum": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Field:
    """One tape column with its constraints; ``None`` means unconstrained."""

    name: str
    kind: str
    allowed: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    high_open: bool = False
    min_len: int | None = None
    max_len: int | None = None
    pattern: str | None = None
    required: bool = True
    nullable: bool = False
    default: Any = None

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]


def _text(name: str, **kw: Any) -> Field:
    return Field(name, "string", **kw)


def _category(name: str, allowed: tuple[str, ...], **kw: Any) -> Field:
    return Field(name, "enum", allowed=allowed, **kw)


def _amount(name: str, **kw: Any) -> Field:
    return Field(name, "double", low=0.0, **kw)


def _unit(name: str) -> Field:
    return Field(name, "double", low=0.0, high=1.0)


def _day(name: str, **kw: Any) -> Field:
    return Field(name, "date", **kw)


def _flag(name: str, **kw: Any) -> Field:
    return Field(name, "bool", **kw)


_OFF = {"required": False, "default": False}

FIELDS: tuple[Field, ...] = (
    _text("loan_id", min_len=1),
    _text("borrower_id", min_len=1),
    _category("borrower_type", BORROWER_TYPES),
    _day("origination_date"),
    _day("maturity_date"),
    _amount("original_principal"),
    _amount("current_balance"),
    Field("interest_rate", "double", low=0.0, high=1.0, high_open=True),
    _category("rate_type", RATE_TYPES),
    _day("rentevast_einddatum", required=False, nullable=True),
    _category("repayment_type", REPAYMENT_TYPES),
    _flag("tax_deduction_eligible"),
    Field("hra_phase_out_rate", "double", low=0.0, high=MAX_HRA_RATE),
    _amount("interest_only_portion", required=False, default=0.0),
    _text("currency", min_len=3, max_len=3),
    _amount("property_value_at_origination"),
    _amount("taxatie_waarde"),
    _day("taxatie_date"),
    _category("taxatie_type", VALUATION_TYPES),
    _amount("woz_waarde"),
    _day("woz_reference_date"),
    _amount("property_value_current"),
    _text("pc6", pattern=PC6_PATTERN),
    _text("gemeente", min_len=1),
    _category("property_type", PROPERTY_TYPES),
    Field("bouwjaar", "int", low=1700, high=2100),
    _category("energy_label", ENERGY_LABELS),
    _flag("nhg_flag"),
    _amount("nhg_cap_at_origination"),
    _amount("nhg_premium_paid"),
    _unit("pd_12m"),
    _unit("pd_lifetime"),
    _unit("lgd"),
    _amount("ead"),
    _category("ifrs9_stage", STAGES),
    _category("sicr_trigger_reason", SICR_REASONS, required=False, default="NONE"),
    Field("days_past_due", "int", low=0),
    _category("arrears_bucket", ARREARS_BUCKETS),
    _flag("restructured_flag", **_OFF),
    _flag("watchlist_flag", **_OFF),
    _flag("unlikely_to_pay_flag", **_OFF),
    _unit("risk_weight"),
    _amount("gross_household_income"),
    _flag("partner_income_included", **_OFF),
    _amount("student_loan_debt", required=False, default=0.0),
    _category("bkr_score_band", SCORE_BANDS),
    _flag("bkr_negative_registration_flag", **_OFF),
    _amount("dscr"),
)

COLUMNS: tuple[str, ...] = tuple(f.name for f in FIELDS)
BY_NAME: dict[str, Field] = {f.name: f for f in FIELDS}

TAPE_SCHEMA = T.StructType([T.StructField(f.name, f.spark_type) for f in FIELDS])
LABELLED_SCHEMA = T.StructType([*TAPE_SCHEMA.fields, T.StructField(LABEL_COLUMN, T.StringType())])

"""SQL for the queries over sources, sinks and spoiled tapes, written from the constraints of the record."""

from __future__ import annotations

# Columns in the order of the record: (name, kind, what else must hold).
_ENUMS = {
    "borrower_type": "'STARTER','DOORSTROMER','OUDERE'",
    "rate_type": "'VARIABEL','RENTEVAST_5J','RENTEVAST_10J','RENTEVAST_20J','RENTEVAST_30J'",
    "repayment_type": "'ANNUITEIT','LINEAIR','AFLOSSINGSVRIJ','BANKSPAAR','SPAAR','BELEGGING','HYBRIDE'",
    "taxatie_type": "'MARKETVALUE','EXECUTIEWAARDE','MODELMATIG'",
    "property_type": "'APPARTEMENT','TUSSENWONING','HOEKWONING','2-ONDER-1-KAP','VRIJSTAAND'",
    "energy_label": "'A++++','A+++','A++','A+','A','B','C','D','E','F','G'",
    "ifrs9_stage": "'1','2','3'",
    "sicr_trigger_reason": "'NONE','QUANT_PD_INCREASE','DPD_30_BACKSTOP','FORBEARANCE','WATCHLIST','MACRO_OVERLAY',"
                           "'CLIMATE_TRANSITION'",
    "arrears_bucket": "'0','1-30','31-60','61-90','90+'",
    "bkr_score_band": "'A','B','C','D','E'",
}
_ORDER = """loan_id borrower_id borrower_type origination_date maturity_date original_principal current_balance
interest_rate rate_type rentevast_einddatum repayment_type tax_deduction_eligible hra_phase_out_rate
interest_only_portion currency property_value_at_origination taxatie_waarde taxatie_date taxatie_type woz_waarde
woz_reference_date property_value_current pc6 gemeente property_type bouwjaar energy_label nhg_flag
nhg_cap_at_origination nhg_premium_paid pd_12m pd_lifetime lgd ead ifrs9_stage sicr_trigger_reason days_past_due
arrears_bucket restructured_flag watchlist_flag unlikely_to_pay_flag risk_weight gross_household_income
partner_income_included student_loan_debt bkr_score_band bkr_negative_registration_flag dscr""".split()
_DATES = {"origination_date", "maturity_date", "rentevast_einddatum", "taxatie_date", "woz_reference_date"}
_FLAGS = {"tax_deduction_eligible", "nhg_flag", "restructured_flag", "watchlist_flag", "unlikely_to_pay_flag",
          "partner_income_included", "bkr_negative_registration_flag"}
_WHOLE = {"bouwjaar": (1700, 2100), "days_past_due": (0, None)}
_TEXTS = {"loan_id", "borrower_id", "currency", "pc6", "gemeente"}
_TOPS = {"pd_12m": "1", "pd_lifetime": "1", "lgd": "1", "risk_weight": "1", "hra_phase_out_rate": "55e-2"}
_SIZE = len(_ORDER)


def _kind(column: str) -> str:
    if column in _DATES:
        return "date"
    if column in _FLAGS:
        return "bool"
    if column in _WHOLE:
        return "int"
    if column in _TEXTS:
        return "string"
    return "enum" if column in _ENUMS else "float"


def _code(column: str) -> str:
    """WHEN branches that name the first violation of a column."""
    kind, c = _kind(column), column
    if kind == "enum":
        return f"WHEN {c} IS NULL OR {c} NOT IN ({_ENUMS[c]}) THEN 'enum'"
    null = "" if c == "rentevast_einddatum" else f"WHEN {c} IS NULL THEN '{kind}_type' "
    if kind in ("date", "bool"):
        return null
    if kind == "string":
        if c == "pc6":
            return f"{null}WHEN NOT regexp_full_match(trim(pc6), '[0-9]{{4}}[A-Z]{{2}}') THEN 'string_pattern_mismatch'"
        if c == "currency":
            return (f"{null}WHEN length(trim(currency)) < 3 THEN 'string_too_short'"
                    " WHEN length(trim(currency)) > 3 THEN 'string_too_long'")
        return f"{null}WHEN length(trim({c})) < 1 THEN 'string_too_short'"
    if kind == "int":
        low, high = _WHOLE[c]
        top = f"WHEN {c} > {high} THEN 'less_than_equal' " if high else ""
        return f"{null}{top}WHEN {c} < {low} THEN 'greater_than_equal'"
    if c == "interest_rate":
        return f"{null}WHEN {c} >= 1 THEN 'less_than' WHEN {c} < 0 THEN 'greater_than_equal'"
    if c in _TOPS:
        return f"{null}WHEN {c} > {_TOPS[c]} THEN 'less_than_equal' WHEN {c} < 0 THEN 'greater_than_equal'"
    return f"{null}WHEN {c} < 0 OR isnan({c}) THEN 'greater_than_equal'"


def _spoiled(number: str) -> str:
    """Every column with the defect of its turn."""
    columns = []
    for i, c in enumerate(_ORDER):
        kind = _kind(c)
        low = {"enum": "'ONBEKEND'", "string": "'  '", "float": "-1e0"}.get(kind)
        low = {"pc6": "'12 AB'", "bouwjaar": "1699", "days_past_due": "-1"}.get(c, low)
        high = {"currency": "'EURO'", "bouwjaar": "2101", "interest_rate": "2e0", "hra_phase_out_rate": "155e-2"}.get(c)
        high = high or ("2e0" if c in _TOPS else None)
        odd = "CAST('NaN' AS DOUBLE)" if kind == "float" else None
        whens = "".join(f" WHEN {step * _SIZE + i} THEN {v}" for step, v in enumerate((low, high, odd), 1) if v)
        columns.append(f"CASE ({number}) % {4 * _SIZE} WHEN {i} THEN NULL{whens} ELSE {c} END AS {c}")
    return ", ".join(columns)


def _found(source: str, cross: dict[str, str], unreadable: bool = False, skip: tuple[str, ...] = (), more: str = "") -> str:
    """Violations of a table that has the loan's number n."""
    parts = []
    for i, c in enumerate(_ORDER):
        bad = ""
        if unreadable and _kind(c) not in ("string", "enum"):
            bad = f"WHEN n % {_SIZE} = {i} THEN '{_kind(c)}_parsing' "
        branches = bad + _code(c)
        if c not in skip and branches:
            parts.append(f"SELECT n, trim(loan_id) AS loan_id, '{c}' AS field, CASE {branches} END AS code FROM {source}")
    fields = " UNION ALL ".join(parts) + more
    across = " UNION ALL ".join(
        f"SELECT trim(loan_id) AS loan_id, CAST(NULL AS VARCHAR) AS field, '{code}' AS code FROM {source}"
        f" WHERE n NOT IN (SELECT n FROM v) AND NOT ({holds})" for code, holds in cross.items())
    return f"""v AS (SELECT * FROM ({fields}) WHERE code IS NOT NULL),
found AS (SELECT loan_id, field, code FROM v UNION ALL {across})"""


def oracles(tape: str, cross: dict[str, str], caps: str, rates: str, columns: tuple[str, ...], first_issues: str) -> dict[str, str]:
    """SQL by query name; the arguments are SQL pieces of the other oracles."""
    number = "CAST(substr(loan_id, 4, 9) AS BIGINT)"
    spoiled = f"{tape}, s AS (SELECT {number} AS n, {_spoiled(number)} FROM tape)"
    plain = f"{tape}, s AS (SELECT {number} AS n, * FROM tape)"
    rows = "SELECT loan_id, field, code FROM found"
    other = (" UNION ALL SELECT n, trim(loan_id), 'dscr', 'missing' FROM s UNION ALL SELECT n, trim(loan_id), 'remark', 'extra_forbidden' FROM s")
    vintage = "year(origination_date)"
    stage = "('stage-' || ifrs9_stage || '.parquet')"
    return {
        "violations_all_columns": f"{spoiled}, {_found('s', cross)} {rows}",
        "violations_text_tape": f"{plain}, {_found('s', cross, unreadable=True)} {rows}",
        "violations_other_columns": f"{plain}, {_found('s', cross, skip=('dscr', 'watchlist_flag'), more=other)} {rows}",
        "spoiled_counts": f"""{spoiled}, {_found('s', cross)}, bad AS (SELECT n FROM v
UNION SELECT n FROM s WHERE n NOT IN (SELECT n FROM v) AND NOT ({' AND '.join(cross.values())}))
SELECT (SELECT count(*) FROM s) AS row_count, (SELECT count(*) FROM s) - (SELECT count(*) FROM bad) AS valid_count,
  (SELECT count(*) FROM bad) AS skipped_count""",
        "load_parquet_strict": first_issues,
        "load_csv_strict": first_issues,
        "list_named": f"""{tape} SELECT CAST(ifrs9_stage AS BIGINT) - 1 AS place, {stage} AS tape, loan_id FROM tape
WHERE ifrs9_stage IN ('1', '2', '3')""",
        "store_round_trip": f"{tape} SELECT {', '.join(columns)} FROM tape",
        "store_by_vintage": f"""{tape} SELECT loan_id, origination_date, current_balance FROM tape
WHERE origination_date >= DATE '2015-01-01' AND origination_date < DATE '2019-01-01'""",
        "store_by_stage": f"{tape} SELECT loan_id, ifrs9_stage, current_balance FROM tape WHERE ifrs9_stage = '2'",
        "reference_nhg": f"""{tape} SELECT loan_id, c.cap AS nhg_cap FROM tape LEFT JOIN {caps} ON c.year = {vintage} - 3""",
        "reference_hra": f"""{tape} SELECT loan_id, h.pct * 1e-2 AS hra_rate FROM tape LEFT JOIN {rates} ON h.year = {vintage}""",
    }

"""Independent SQL for every registered query that SQL can express.

Hand-written from the meaning of the operators, for a second engine that sees the
test tables under their plain names.
"""

from __future__ import annotations

import re

from polderbook.model import COLUMNS, FIELDS
from polderbook.operators.anacredit import REQUIRED_ATTRIBUTES
from polderbook.plans import source_oracle
from polderbook.plans.tape_view import oracle_prefix

_REF = "DATE '2025-06-01'"

_FIELDS_OK = """
  length(trim(loan_id)) >= 1 AND length(trim(borrower_id)) >= 1
  AND borrower_type IN ('STARTER','DOORSTROMER','OUDERE')
  AND origination_date IS NOT NULL AND maturity_date IS NOT NULL
  AND original_principal >= 0 AND current_balance >= 0
  AND interest_rate >= 0 AND interest_rate < 1
  AND rate_type IN ('VARIABEL','RENTEVAST_5J','RENTEVAST_10J','RENTEVAST_20J','RENTEVAST_30J')
  AND repayment_type IN ('ANNUITEIT','LINEAIR','AFLOSSINGSVRIJ','BANKSPAAR','SPAAR','BELEGGING','HYBRIDE')
  AND tax_deduction_eligible IS NOT NULL
  AND hra_phase_out_rate BETWEEN 0 AND 55e-2 AND interest_only_portion >= 0
  AND length(trim(currency)) = 3
  AND property_value_at_origination >= 0 AND taxatie_waarde >= 0 AND taxatie_date IS NOT NULL
  AND taxatie_type IN ('MARKETVALUE','EXECUTIEWAARDE','MODELMATIG')
  AND woz_waarde >= 0 AND woz_reference_date IS NOT NULL AND property_value_current >= 0
  AND regexp_full_match(trim(pc6), '[0-9]{4}[A-Z]{2}') AND length(trim(gemeente)) >= 1
  AND property_type IN ('APPARTEMENT','TUSSENWONING','HOEKWONING','2-ONDER-1-KAP','VRIJSTAAND')
  AND bouwjaar BETWEEN 1700 AND 2100
  AND energy_label IN ('A++++','A+++','A++','A+','A','B','C','D','E','F','G')
  AND nhg_flag IS NOT NULL AND nhg_cap_at_origination >= 0 AND nhg_premium_paid >= 0
  AND pd_12m BETWEEN 0 AND 1 AND pd_lifetime BETWEEN 0 AND 1 AND lgd BETWEEN 0 AND 1 AND ead >= 0
  AND ifrs9_stage IN ('1','2','3')
  AND sicr_trigger_reason IN ('NONE','QUANT_PD_INCREASE','DPD_30_BACKSTOP','FORBEARANCE','WATCHLIST',
    'MACRO_OVERLAY','CLIMATE_TRANSITION')
  AND days_past_due >= 0 AND arrears_bucket IN ('0','1-30','31-60','61-90','90+')
  AND restructured_flag IS NOT NULL AND watchlist_flag IS NOT NULL AND unlikely_to_pay_flag IS NOT NULL
  AND risk_weight BETWEEN 0 AND 1 AND gross_household_income >= 0
  AND partner_income_included IS NOT NULL AND student_loan_debt >= 0
  AND bkr_score_band IN ('A','B','C','D','E') AND bkr_negative_registration_flag IS NOT NULL
  AND dscr >= 0"""

_CROSS = {
    "currency_is_eur": "currency = 'EUR'",
    "maturity_after_origination": "maturity_date > origination_date",
    "pd_lifetime_ge_pd_12m": "pd_lifetime >= pd_12m",
    "stage_3_backstop":
        "(ifrs9_stage <> '3' OR days_past_due >= 90 OR unlikely_to_pay_flag OR restructured_flag)",
    "hra_repayment_type":
        "(NOT tax_deduction_eligible OR repayment_type IN ('ANNUITEIT','LINEAIR'))",
    "hra_regime_start":
        "(NOT tax_deduction_eligible OR repayment_type NOT IN ('ANNUITEIT','LINEAIR')"
        " OR origination_date >= DATE '2013-01-01')",
}

_CHECKED = f""",
checked AS (SELECT *, coalesce({_FIELDS_OK}, false) AS fields_ok FROM tape),
flagged AS (SELECT *, fields_ok AND {' AND '.join(_CROSS.values())} AS is_valid FROM checked),
valid AS (SELECT * FROM flagged WHERE is_valid)
"""

_LTV = "CASE WHEN property_value_current = 0 THEN 0e0 ELSE current_balance / property_value_current END"
_EL = "(CASE WHEN ifrs9_stage = '1' THEN pd_12m ELSE pd_lifetime END) * lgd * ead"
_AGE = (f"((year({_REF}) - year(taxatie_date)) * 12 + month({_REF}) - month(taxatie_date))")

# name: (failing condition, severity, dimension)
_RULES = {
    "negative_amortization":
        ("current_balance > original_principal * 1001e-3", "CRITICAL", "integrity"),
    "stage_3_backstop":
        ("ifrs9_stage = '3' AND NOT (days_past_due >= 90 OR unlikely_to_pay_flag OR restructured_flag)",
         "CRITICAL", "integrity"),
    "nhg_cap":
        ("nhg_flag AND original_principal > nhg_cap_at_origination", "CRITICAL", "integrity"),
    "hra_eligibility":
        ("tax_deduction_eligible AND (repayment_type NOT IN ('ANNUITEIT','LINEAIR')"
         " OR origination_date < DATE '2013-01-01')", "HIGH", "integrity"),
    "ltv_consistency": ("property_value_current = 0", "HIGH", "accuracy"),
    "pd_monotonicity": ("pd_lifetime < pd_12m", "HIGH", "integrity"),
    "taxatie_freshness": (f"ifrs9_stage = '1' AND {_AGE} > 36", "MEDIUM", "timeliness"),
    "lti_cap":
        ("gross_household_income <> 0 AND original_principal / gross_household_income > 6",
         "HIGH", "integrity"),
    "interest_only_cap":
        ("tax_deduction_eligible AND interest_only_portion > 5e-1 * property_value_at_origination",
         "HIGH", "integrity"),
}


def _findings(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT loan_id, '{name}' AS rule_name, '{severity}' AS severity,"
        f" '{dimension}' AS bcbs239_dimension, {i} AS pos FROM {source} WHERE {condition}"
        for i, (name, (condition, severity, dimension)) in enumerate(_RULES.items())
    )


_FOUND = f"{_CHECKED}, findings AS ({_findings('valid')})"
_TAPE = oracle_prefix()
_NEXT = oracle_prefix(next_tape=True)


def _rule_counts(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS rule_position, '{name}' AS rule_name, '{severity}' AS severity,"
        f" '{dimension}' AS bcbs239_dimension, count(*) AS loan_count,"
        f" CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS failed_count FROM {source}"
        for i, (name, (condition, severity, dimension)) in enumerate(_RULES.items())
    )


def _violations() -> str:
    field_checks = [
        ("pc6", "string_pattern_mismatch", "NOT regexp_full_match(trim(pc6), '[0-9]{4}[A-Z]{2}')"),
        ("energy_label", "enum",
         "energy_label NOT IN ('A++++','A+++','A++','A+','A','B','C','D','E','F','G')"),
        ("lgd", "less_than_equal", "lgd > 1"),
        ("bkr_score_band", "enum", "bkr_score_band IS NULL OR bkr_score_band NOT IN ('A','B','C','D','E')"),
    ]
    parts = [
        f"SELECT loan_id, '{field}' AS field, '{code}' AS code, {i} AS pos FROM flagged WHERE {bad}"
        for i, (field, code, bad) in enumerate(field_checks)
    ]
    parts += [
        f"SELECT loan_id, CAST(NULL AS STRING) AS field, '{code}' AS code, {100 + i} AS pos"
        f" FROM flagged WHERE fields_ok AND NOT ({holds})"
        for i, (code, holds) in enumerate(_CROSS.items())
    ]
    return " UNION ALL ".join(parts)


def _top(by: str, limit: int) -> str:
    return f"""{_TAPE}{_FOUND},
totals AS (SELECT {by}, count(*) AS finding_count FROM findings GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY loan_id, pos) AS rank FROM findings)
SELECT r.{by}, r.loan_id, r.rule_name, CAST(r.rank AS INT) AS rank,
  t.finding_count, t.finding_count > {limit} AS truncated
FROM ranked r JOIN totals t ON r.{by} = t.{by} WHERE r.rank <= {limit}"""


def _all_keys(by: str, keys: tuple[str, ...]) -> str:
    rows = ", ".join(f"('{k}')" for k in keys)
    return f"""{_TAPE}{_FOUND}
SELECT k.key AS {by}, CAST(count(f.loan_id) AS BIGINT) AS finding_count
FROM (VALUES {rows}) AS k(key) LEFT JOIN findings f ON f.{by} = k.key GROUP BY 1"""


_SUM_BAL = "round(sum(current_balance), 2)"
_TOTAL = "(SELECT sum(current_balance) FROM tape)"
_EXPOSURE = f"count(*) AS loan_count, {_SUM_BAL} AS exposure"
_SHARE = f"round(sum(current_balance) / {_TOTAL}, 6) AS exposure_share"

_ATTRIBUTES = f"""
SELECT loan_id AS contract_identifier, origination_date AS inception_date,
  origination_date AS settlement_date, maturity_date AS legal_final_maturity_date, currency,
  original_principal AS commitment_amount_at_inception, 'Mortgage loan' AS type_of_instrument,
  CASE rate_type WHEN 'VARIABEL' THEN 'Variable' ELSE 'Fixed' END AS type_of_interest_rate,
  interest_rate, false AS project_finance_loan,
  round(CASE WHEN property_value_at_origination = 0 THEN 0e0
    ELSE original_principal / property_value_at_origination END, 6) AS ltv_at_origination,
  borrower_id AS counterparty_identifier, current_balance AS outstanding_nominal_amount,
  CASE WHEN ifrs9_stage = '3' OR days_past_due >= 90 OR unlikely_to_pay_flag OR arrears_bucket = '90+'
    THEN 'Non-performing' ELSE 'Performing' END AS performing_status,
  CASE WHEN ifrs9_stage = '3' THEN 'Default' ELSE 'Not in default' END AS default_status_of_instrument,
  CASE WHEN restructured_flag THEN 'Forborne' ELSE 'Not forborne' END AS forbearance_status,
  {_LTV} AS current_ltv, pd_12m, pd_lifetime, lgd, ead, risk_weight,
  'Residential real estate' || CASE WHEN nhg_flag THEN ' + NHG guarantee' ELSE '' END AS type_of_protection,
  taxatie_waarde AS protection_value,
  CASE taxatie_type WHEN 'MARKETVALUE' THEN 'Market value' WHEN 'EXECUTIEWAARDE' THEN 'Notional amount'
    WHEN 'MODELMATIG' THEN 'Other' END AS type_of_protection_value,
  taxatie_date AS protection_valuation_date, pc6 AS real_estate_postal_code,
  'NL' AS real_estate_country, bouwjaar AS real_estate_construction_year,
  energy_label AS energy_performance_certificate,
  'Stage ' || ifrs9_stage AS accounting_classification_ifrs9_stage,
  round({_EL}, 2) AS accumulated_impairment_amount
FROM valid"""

_CAPS = """(VALUES (2010,265000e0),(2011,350000e0),(2012,320000e0),(2013,290000e0),(2014,265000e0),
(2015,245000e0),(2016,231132e0),(2017,247450e0),(2018,265000e0),(2019,290000e0),(2020,310000e0),
(2021,325000e0),(2022,355000e0),(2023,405000e0),(2024,435000e0),(2025,450000e0)) AS c(year, cap)"""
_HRA = """(VALUES (2013,52e0),(2014,515e-1),(2015,51e0),(2016,505e-1),(2017,50e0),(2018,495e-1),
(2019,49e0),(2020,46e0),(2021,43e0),(2022,40e0),(2023,3693e-2),(2024,3697e-2),(2025,3697e-2),
(2026,3748e-2)) AS h(year, pct)"""
_NIBUD = """(VALUES (2024,30000e0,400e0),(2024,40000e0,425e0),(2024,60000e0,500e0),(2024,80000e0,500e0),
(2024,100000e0,475e0),(2024,150000e0,450e0),(2025,30000e0,400e0),(2025,40000e0,425e0),
(2025,60000e0,500e0),(2025,80000e0,525e0),(2025,100000e0,500e0),(2025,150000e0,475e0)) AS b(year, income, pct)"""

_SICR = f""",
started AS (SELECT *, pd_12m * 15e-1 AS pd0 FROM tape),
hits AS (SELECT *,
  pd_lifetime > pd0 * 25e-1 AND pd_lifetime - pd0 > 5e-3 AS q,
  days_past_due >= 30 AS d, restructured_flag AS f, watchlist_flag AS w,
  coalesce(rentevast_einddatum BETWEEN {_REF} AND DATE '2026-06-01', false) AND dscr < 12e-1 AS m,
  energy_label IN ('E','F','G') AND bouwjaar < 1992 AS c
  FROM started),
staged AS (SELECT *, CASE WHEN days_past_due >= 90 OR unlikely_to_pay_flag THEN '3'
  WHEN q OR d OR f OR w OR m OR c THEN '2' ELSE '1' END AS derived_stage FROM hits)
"""


def _stress(pd: str, lgd: str, extra: str = "") -> str:
    base_pd = "(CASE WHEN ifrs9_stage = '1' THEN pd_12m ELSE pd_lifetime END)"
    return f"""{_TAPE}{extra},
stressed AS (SELECT ifrs9_stage, {base_pd} * lgd * ead AS base_el,
  ({pd.format(pd=base_pd)}) * ({lgd}) * ead AS stressed_el FROM tape)
SELECT ifrs9_stage AS segment, count(*) AS loan_count, round(sum(base_el), 2) AS base_el,
  round(sum(stressed_el), 2) AS stressed_el, round(sum(stressed_el - base_el), 2) AS el_delta,
  CAST(0 AS BIGINT) AS non_finite
FROM stressed GROUP BY 1"""


def _revalued(factor: str) -> str:
    before = f"greatest(0e0, {_LTV} - 6e-1) * 5e-1"
    after = ("greatest(0e0, CASE WHEN property_value_current * ({f}) = 0 THEN 0e0 ELSE "
             "current_balance / (property_value_current * ({f})) END - 6e-1) * 5e-1").format(f=factor)
    return (f"CASE WHEN nhg_flag THEN lgd ELSE greatest(0e0, least(1e0, lgd + {after} - {before})) END")


def _burdened(cost: str, response: str) -> str:
    burden = (f"CASE WHEN gross_household_income = 0 THEN 0e0 ELSE ({cost}) / gross_household_income END")
    return f"least(1e0, {{pd}} * (1 + ({burden}) * {response}))"


_HOUSE = _revalued("8e-1")
_ENERGY = _revalued(
    "CASE energy_label WHEN 'E' THEN 1e0 - 5e-2 WHEN 'F' THEN 1e0 - 10e-2"
    " WHEN 'G' THEN 1e0 - 15e-2 ELSE 1e0 END"
)
_HRA_COST = _burdened(
    "CASE WHEN tax_deduction_eligible THEN current_balance * interest_rate *"
    " greatest(0e0, hra_phase_out_rate - 25e-2) ELSE 0e0 END", "5e0"
)
_RESET_COST = _burdened(
    "CASE WHEN rentevast_einddatum BETWEEN DATE '2025-01-01' AND DATE '2028-12-31'"
    " THEN current_balance * 2e-2 ELSE 0e0 END", "5e0"
)



def _bridge(lgd: str = "lgd") -> str:
    """Bridge over four shocks; a loan without a loss counts in no amount."""
    pd = "(CASE WHEN ifrs9_stage = '1' THEN pd_12m ELSE pd_lifetime END)"
    energy = "(CASE energy_label WHEN 'E' THEN 95e-2 WHEN 'F' THEN 9e-1 WHEN 'G' THEN 85e-2 ELSE 1e0 END)"
    cost = "CASE WHEN gross_household_income = 0 THEN 0e0 ELSE 5e0 * ({}) / gross_household_income END"
    hra = cost.format("CASE WHEN tax_deduction_eligible THEN current_balance * interest_rate * greatest(0e0, hra_phase_out_rate - 25e-2)"
                      " ELSE 0e0 END")
    reset = cost.format("CASE WHEN rentevast_einddatum BETWEEN DATE '2025-01-01' AND DATE '2028-12-31' THEN current_balance * 2e-2"
                        " ELSE 0e0 END")
    both = _revalued("8e-1 * " + energy)
    names = ("base", "house_price", "energy", "deduction", "rate_reset", "interaction", "stressed")
    rows = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    amount = "CASE position " + " ".join(f"WHEN {i} THEN {a}" for i, a in enumerate(
        ("b", "h - b", "e - b", "d - b", "r - b", "s - h - e - d - r + 3 * b", "s"))) + " END"
    return f"""{_TAPE}, odd AS (SELECT * REPLACE ({lgd} AS lgd) FROM tape),
loans AS (SELECT {pd} * lgd * ead AS b, {pd} * ({_revalued("8e-1")}) * ead AS h, {pd} * ({_revalued(energy)}) * ead AS e,
  least(1e0, {pd} * (1 + {hra})) * lgd * ead AS d, least(1e0, {pd} * (1 + {reset})) * lgd * ead AS r,
  least(1e0, {pd} * (1 + {hra} + {reset})) * ({both}) * ead AS s, lgd IS NULL AS lost FROM odd),
sums AS (SELECT coalesce(sum(b) FILTER (WHERE NOT lost), 0) AS b, coalesce(sum(h) FILTER (WHERE NOT lost), 0) AS h,
  coalesce(sum(e) FILTER (WHERE NOT lost), 0) AS e, coalesce(sum(d) FILTER (WHERE NOT lost), 0) AS d,
  coalesce(sum(r) FILTER (WHERE NOT lost), 0) AS r, coalesce(sum(s) FILTER (WHERE NOT lost), 0) AS s,
  CAST(count(*) FILTER (WHERE lost) AS BIGINT) AS non_finite FROM loans),
steps AS (SELECT position, step, {amount} AS amount, b, s, non_finite FROM sums, (VALUES {rows}) v(position, step))
SELECT CAST(position AS INT) AS position, step, round(amount, 2) AS amount,
  round(CASE step WHEN 'stressed' THEN s ELSE sum(amount) OVER (ORDER BY position) END, 2) AS cumulative,
  round(abs(s - sum(amount) FILTER (WHERE step <> 'stressed') OVER ()), 2) AS gap, non_finite,
  CASE WHEN non_finite > 0 OR abs(s - b) > 3e9 THEN 'FAILED' ELSE 'OK' END AS status FROM steps"""


_INDICATORS = (
    "total_exposure", "weighted_avg_pd_12m", "weighted_avg_pd_lifetime", "weighted_avg_current_ltv",
    "weighted_avg_hra_phase_out_rate", "nhg_share", "aflossingsvrij_share", "weighted_avg_current_ltv_safe",
)
_METRICS = tuple(f.name for f in FIELDS if f.kind in ("int", "double"))
_KS_SERIES = " + ".join(
    f"{'2e0' if j % 2 else '-2e0'} * exp(-2e0 * {j} * {j} * lam * lam)" for j in range(1, 101)
)


def _ks() -> str:
    samples = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value, {n0} AS n0, {1 - n0} AS n1 FROM {t}"
        for m in _METRICS for t, n0 in (("tape", 1), ("next_tape", 0))
    )
    return f"""{_NEXT},
samples AS ({samples}),
counts AS (SELECT metric, value, sum(n0) AS n0, sum(n1) AS n1 FROM samples GROUP BY 1, 2),
steps AS (SELECT metric,
  sum(n0) OVER w / CAST(sum(n0) OVER (PARTITION BY metric) AS DOUBLE) AS f0,
  sum(n1) OVER w / CAST(sum(n1) OVER (PARTITION BY metric) AS DOUBLE) AS f1,
  sum(n0) OVER (PARTITION BY metric) AS t0, sum(n1) OVER (PARTITION BY metric) AS t1
  FROM counts WINDOW w AS (PARTITION BY metric ORDER BY value)),
gaps AS (SELECT metric, CAST(max(t0) AS BIGINT) AS n_before, CAST(max(t1) AS BIGINT) AS n_after,
  max(abs(f0 - f1)) AS d FROM steps GROUP BY 1),
scaled AS (SELECT *, sqrt(CAST(n_before AS DOUBLE) * n_after / (n_before + n_after)) * d AS lam FROM gaps)
SELECT metric, n_before, n_after, round(d, 8) AS ks_statistic,
  round(CASE WHEN lam < 2e-1 THEN 1e0 ELSE greatest(0e0, least(1e0, {_KS_SERIES})) END, 6) AS p_value
FROM scaled"""


_OUTLIER_METRICS = _METRICS


def _outliers() -> str:
    medians = ", ".join(f"median({m}) AS med_{m}" for m in _OUTLIER_METRICS)
    mads = ", ".join(f"median(abs({m} - med_{m})) AS mad_{m}" for m in _OUTLIER_METRICS)
    scores = ", ".join(
        f"CASE WHEN mad_{m} > 0 THEN abs({m} - med_{m}) / (mad_{m} * 14826e-4) ELSE 0e0 END AS z_{m}"
        for m in _OUTLIER_METRICS
    )
    reasons = ", ".join(f"CASE WHEN z_{m} > 2 THEN '{m}' END" for m in _OUTLIER_METRICS)
    worst = ", ".join(f"z_{m}" for m in _OUTLIER_METRICS)
    return f"""{_TAPE},
med AS (SELECT repayment_type, {medians} FROM tape GROUP BY 1),
mad AS (SELECT t.repayment_type, {mads} FROM tape t JOIN med USING (repayment_type) GROUP BY 1),
z AS (SELECT loan_id, t.repayment_type, {scores}
  FROM tape t JOIN med USING (repayment_type) JOIN mad USING (repayment_type))
SELECT loan_id, repayment_type, concat_ws(',', {reasons}) AS reasons,
  round(greatest({worst}), 6) AS max_abs_z, true AS degraded_mode
FROM z WHERE greatest({worst}) > 2"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["tape_view"] = f"{_TAPE} SELECT * FROM tape"

    # quick scan
    w = "sum({v} * current_balance) / sum(current_balance)"
    scan_ltv = ("current_balance / (CASE WHEN property_value_current = 0 THEN 1e0"
                " ELSE property_value_current END)")
    q["quick_scan_kpis"] = f"""{_TAPE} SELECT count(*) AS loan_count,
  count(DISTINCT borrower_id) AS borrower_count, {_SUM_BAL} AS total_exposure,
  round({w.format(v='pd_12m')}, 8) AS weighted_avg_pd_12m,
  round({w.format(v='pd_lifetime')}, 8) AS weighted_avg_pd_lifetime,
  round({w.format(v=scan_ltv)}, 4) AS weighted_avg_current_ltv,
  round({w.format(v='hra_phase_out_rate')}, 8) AS weighted_avg_hra_phase_out_rate,
  round(CAST(count(*) FILTER (WHERE nhg_flag) AS DOUBLE) / count(*), 8) AS nhg_share,
  round(CAST(count(*) FILTER (WHERE repayment_type = 'AFLOSSINGSVRIJ') AS DOUBLE) / count(*), 8)
    AS aflossingsvrij_share,
  round({w.format(v='(' + _LTV + ')')}, 8) AS weighted_avg_current_ltv_safe FROM tape"""
    for name, column in (("stage_mix", "ifrs9_stage"), ("energy_label_mix", "energy_label")):
        q[name] = f"""{_TAPE} SELECT '{column}' AS dimension, {column} AS key,
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM tape), 8) AS share FROM tape GROUP BY 2"""
    q["vintage_histogram"] = f"""{_TAPE} SELECT CAST(year(origination_date) AS INT) AS year,
  count(*) AS loan_count FROM tape GROUP BY 1"""
    q["derived_fields"] = f"""{_TAPE} SELECT loan_id, {_LTV} AS current_ltv,
  CASE WHEN gross_household_income = 0 THEN 0e0 ELSE original_principal / gross_household_income END
    AS original_lti, {_EL} AS expected_loss FROM tape"""
    q["valuation_age"] = f"{_TAPE} SELECT loan_id, CAST({_AGE} AS INT) AS months FROM tape"

    # validation
    q["schema_valid_flag"] = f"{_TAPE}{_CHECKED} SELECT loan_id, is_valid FROM flagged"
    q["schema_violations"] = f"""{_TAPE}{_CHECKED}, v AS ({_violations()})
SELECT loan_id, field, code FROM v"""
    q["first_issues"] = f"""{_TAPE}{_CHECKED}, v AS ({_violations()}),
r AS (SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY pos) AS n FROM v)
SELECT loan_id, field, code FROM r WHERE n = 1 ORDER BY loan_id LIMIT 10"""
    q["valid_count"] = f"""{_TAPE}{_CHECKED} SELECT count(*) AS row_count,
  CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid_count,
  CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS skipped_count FROM flagged"""

    # rules
    q["rule_failures"] = f"""{_TAPE}{_FOUND}
SELECT loan_id, rule_name, severity, bcbs239_dimension, false AS passed FROM findings"""
    q["rule_failures_raw"] = f"""{_TAPE}, findings AS ({_findings('tape')})
SELECT loan_id, rule_name, severity, bcbs239_dimension, false AS passed FROM findings"""
    q["rule_counts"] = f"{_TAPE}{_CHECKED} {_rule_counts('valid')}"
    q["rule_counts_raw"] = f"{_TAPE} {_rule_counts('tape')}"
    for name, (condition, severity, dimension) in _RULES.items():
        q[f"rule_{name}"] = f"""{_TAPE}{_CHECKED}
SELECT loan_id, '{name}' AS rule_name, CASE WHEN {condition} THEN '{severity}' ELSE 'LOW' END AS severity,
  '{dimension}' AS bcbs239_dimension, NOT coalesce({condition}, false) AS passed FROM valid"""
    q["findings_critical"] = f"""{_TAPE}{_FOUND}
SELECT loan_id, rule_name FROM findings WHERE severity = 'CRITICAL'"""
    q["flagged_loans"] = f"""{_TAPE}{_FOUND}
SELECT loan_id, original_principal, nhg_cap_at_origination FROM tape
WHERE loan_id IN (SELECT loan_id FROM findings WHERE rule_name = 'nhg_cap')"""

    # AnaCredit
    q["anacredit_map"] = f"{_TAPE}{_CHECKED} {_ATTRIBUTES}"
    q["anacredit_conformance"] = f"""{_TAPE}{_CHECKED}
SELECT count(*) AS loan_count, count(*) AS conforming_count, 1e0 AS conformance_share FROM valid"""
    q["anacredit_tampered"] = f"""{_TAPE}{_CHECKED}, a AS ({_ATTRIBUTES}),
b AS (SELECT contract_identifier AS loan_id,
  CAST(right(contract_identifier, 9) AS BIGINT) % 10 = 0 AS bad_currency,
  CAST(right(contract_identifier, 9) AS BIGINT) % 7 = 0 AS no_amount FROM a)
SELECT loan_id, NOT no_amount AS populated, NOT bad_currency AS enumerated,
  CASE WHEN no_amount THEN 'outstanding_nominal_amount' ELSE '' END AS missing_attributes,
  CASE WHEN bad_currency THEN 'currency is ''XYZ'', known are: EUR' ELSE '' END
    AS invalid_values,
  NOT no_amount AND NOT bad_currency AS conforming FROM b"""
    q["anacredit_extra"] = f"""{_TAPE}{_CHECKED} SELECT loan_id AS contract_identifier,
  {_REF} AS reference_date,
  CASE rate_type WHEN 'VARIABEL' THEN 'Continuous' ELSE 'At rentevast end' END
    AS interest_rate_reset_frequency,
  CAST(NULL AS STRING) AS repayment_rights, 'Not securitised' AS type_of_securitisation,
  'Not encumbered' AS sources_of_encumbrance, CAST(NULL AS DATE) AS date_of_default_status,
  CASE WHEN restructured_flag THEN 'Forborne' ELSE 'Not forborne' END AS forbearance_renegotiation_status,
  CASE energy_label WHEN 'A++++' THEN 'A+++' ELSE energy_label END AS energy_performance_certificate_capped
FROM valid"""
    q["counterparty_default"] = f"""{_TAPE}
SELECT loan_id, borrower_id, CASE WHEN max(CASE ifrs9_stage WHEN '3' THEN 1 ELSE 0 END)
  OVER (PARTITION BY borrower_id) = 1 THEN 'Default' ELSE 'Not in default' END
  AS default_status_of_counterparty FROM tape"""

    # report
    q["findings_by_severity"] = _all_keys("severity", ("CRITICAL", "HIGH", "MEDIUM", "LOW"))
    q["findings_by_dimension"] = _all_keys(
        "bcbs239_dimension", ("accuracy", "completeness", "timeliness", "integrity")
    )
    q["top_findings_severity"] = _top("severity", 50)
    q["top_findings_dimension"] = _top("bcbs239_dimension", 25)
    q["report_header"] = f"""{_TAPE}{_CHECKED} SELECT 'driver' AS tape_id, {_REF} AS reference_date,
  (SELECT count(*) FROM tape) AS total_loans, count(*) AS validated_loans,
  100e0 AS conformance_pct FROM valid"""
    target = ("CASE easter_egg WHEN 'NHG_CAP_BREACH_BATCH' THEN {nhg} WHEN"
              " 'HIGH_INTEREST_ONLY_CLUSTER' THEN {io} ELSE {stale} END")
    caught = target.format(nhg=_RULES["nhg_cap"][0], io=_RULES["interest_only_cap"][0],
                           stale=_RULES["taxatie_freshness"][0])
    names = target.format(nhg="'nhg_cap'", io="'interest_only_cap'", stale="'taxatie_freshness'")
    scope = target.format(nhg="true", io="tax_deduction_eligible", stale="ifrs9_stage = '1'")
    q["cohort_recall"] = f"""{_TAPE}{_CHECKED}, l AS (SELECT easter_egg AS cohort, {names} AS rule_name,
  is_valid AS v, is_valid AND {scope} AS s, is_valid AND {caught} AS c FROM flagged
  WHERE easter_egg IN ('NHG_CAP_BREACH_BATCH','HIGH_INTEREST_ONLY_CLUSTER','STALE_TAXATIE_CLUSTER')),
g AS (SELECT cohort, rule_name, count(*) AS seeded, CAST(count(*) FILTER (WHERE v) AS BIGINT) AS seeded_valid,
  CAST(count(*) FILTER (WHERE s) AS BIGINT) AS in_scope, CAST(count(*) FILTER (WHERE c) AS BIGINT) AS caught
  FROM l GROUP BY 1, 2)
SELECT *, round(CAST(caught AS DOUBLE) / seeded_valid, 8) AS recall,
  round(CAST(caught AS DOUBLE) / in_scope, 8) AS recall_in_scope FROM g"""

    # store filters, lookups, profiles
    q["query_by_vintage"] = f"""{_TAPE} SELECT loan_id, origination_date, current_balance FROM tape
WHERE origination_date BETWEEN DATE '2015-01-01' AND DATE '2018-12-31'"""
    q["query_by_stage"] = f"""{_TAPE} SELECT loan_id, ifrs9_stage, current_balance FROM tape
WHERE ifrs9_stage = '2'"""
    year = "year(origination_date)"
    q["nhg_cap_lookup"] = f"""{_TAPE} SELECT t.loan_id, c.cap AS nhg_cap FROM tape t
JOIN {_CAPS} ON c.year = least(greatest({year} - 3, 2010), 2025)"""
    q["hra_rate_lookup"] = f"""{_TAPE} SELECT t.loan_id, h.pct / 100 AS hra_rate FROM tape t
JOIN {_HRA} ON h.year = least(greatest({year}, 2013), 2026)"""
    q["nhg_cap_published"] = f"""{_TAPE} SELECT t.loan_id, t.nhg_cap_at_origination, c.cap AS published_cap
FROM tape t JOIN {_CAPS} ON c.year = least(greatest({year}, 2010), 2025)
WHERE t.nhg_cap_at_origination <> c.cap"""
    q["nibud_lti"] = f"""{_TAPE}, banded AS (SELECT t.loan_id, t.gross_household_income,
  original_principal / gross_household_income AS original_lti, b.pct / 100 AS nibud_factor,
  row_number() OVER (PARTITION BY t.loan_id ORDER BY b.income <= t.gross_household_income DESC,
    CASE WHEN b.income <= t.gross_household_income THEN -b.income ELSE b.income END) AS n
  FROM tape t LEFT JOIN {_NIBUD} ON b.year = {year})
SELECT loan_id, original_lti, nibud_factor, original_lti > nibud_factor AS exceeds_nibud, nibud_factor IS NOT NULL AS assessed
FROM banded WHERE n = 1"""
    old = "CAST(count(*) FILTER (WHERE {a} AND {b}) AS DOUBLE) / count(*) FILTER (WHERE {b})"

    def shares(a: str, b: str) -> str:
        return f"round({old.format(a=a, b=b)}, 8)"

    wave = "rentevast_einddatum BETWEEN DATE '2025-01-01' AND DATE '2028-12-31'"
    q["profile_shares"] = f"""{_TAPE} SELECT
  {shares("repayment_type = 'ANNUITEIT'", "origination_date >= DATE '2014-01-01'")}
    AS annuity_share_post_2013,
  {shares("repayment_type IN ('AFLOSSINGSVRIJ','SPAAR','HYBRIDE')", "origination_date < DATE '2013-01-01'")}
    AS legacy_share_pre_2013,
  {shares("energy_label IN ('C','D','E','F','G')", "bouwjaar < 1992")} AS low_label_share_old_stock,
  {shares("energy_label IN ('A++++','A+++','A++','A+','A')", "bouwjaar >= 2015")}
    AS high_label_share_new_stock,
  round(CAST(count(*) FILTER (WHERE {wave}) AS DOUBLE) / count(*), 8) AS reset_wave_share FROM tape"""
    q["profile_assertions"] = f"""{_TAPE} SELECT
  bool_and(regexp_full_match(pc6, '[0-9]{{4}}[A-Z]{{2}}')) AS all_pc6_valid,
  bool_and(currency = 'EUR') AS all_currency_eur,
  CAST(min(year(origination_date)) AS INT) AS min_vintage,
  CAST(max(year(origination_date)) AS INT) AS max_vintage,
  count(DISTINCT energy_label) AS energy_label_count FROM tape"""

    # portfolio
    q["vintage_arrears"] = f"""{_TAPE}, g AS (SELECT CAST({year} AS INT) AS vintage, arrears_bucket,
  {_EXPOSURE} FROM tape GROUP BY 1, 2)
SELECT *, round(loan_count / CAST(sum(loan_count) OVER (PARTITION BY vintage) AS DOUBLE), 8)
  AS share_of_vintage FROM g"""
    buckets = ", ".join(
        f"CAST(count(*) FILTER (WHERE arrears_bucket = '{b}') AS BIGINT) AS \"{b}\""
        for b in ("0", "1-30", "31-60", "61-90", "90+")
    )
    q["vintage_arrears_matrix"] = f"""{_TAPE} SELECT CAST({year} AS INT) AS vintage, {buckets}
FROM tape GROUP BY 1"""
    q["concentration_pc4"] = f"""{_TAPE} SELECT substr(pc6, 1, 4) AS pc4, {_EXPOSURE}, {_SHARE}
FROM tape GROUP BY 1"""
    q["concentration_gemeente"] = f"""{_TAPE} SELECT gemeente, {_EXPOSURE}, {_SHARE}
FROM tape GROUP BY 1 ORDER BY sum(current_balance) DESC, gemeente LIMIT 5"""
    q["borrower_top"] = f"""{_TAPE} SELECT borrower_id, {_EXPOSURE}, {_SHARE}
FROM tape GROUP BY 1 ORDER BY sum(current_balance) DESC, borrower_id LIMIT 20"""
    band = (f"CASE WHEN {_LTV} < 5e-1 THEN 0 WHEN {_LTV} < 7e-1 THEN 1 WHEN {_LTV} < 9e-1 THEN 2"
            f" WHEN {_LTV} < 1e0 THEN 3 ELSE 4 END")
    q["ltv_bands"] = f"""{_TAPE} SELECT {band} AS band,
  CASE {band} WHEN 1 THEN 5e-1 WHEN 2 THEN 7e-1 WHEN 3 THEN 9e-1 WHEN 4 THEN 1e0 END AS ltv_from,
  CASE {band} WHEN 0 THEN 5e-1 WHEN 1 THEN 7e-1 WHEN 2 THEN 9e-1 WHEN 3 THEN 1e0 END AS ltv_to,
  {_EXPOSURE}, {_SHARE} FROM tape GROUP BY 1, 2, 3"""
    q["rentevast_waterfall"] = f"""{_TAPE} SELECT CAST(year(rentevast_einddatum) AS INT) AS expiry_year,
  {_EXPOSURE}, {_SHARE}, coalesce(year(rentevast_einddatum) BETWEEN 2025 AND 2028, false) AS in_reset_wave
FROM tape GROUP BY 1, year(rentevast_einddatum)"""
    built = ("CASE WHEN bouwjaar < 1992 THEN '<1992' WHEN bouwjaar < 2015 THEN '1992-2014'"
             " ELSE '>=2015' END")
    q["energy_by_age"] = f"""{_TAPE} SELECT energy_label, {built} AS built, {_EXPOSURE}, {_SHARE}
FROM tape GROUP BY 1, 2"""
    q["rwa_density"] = f"""{_TAPE} SELECT round(sum(risk_weight * ead), 2) AS rwa, round(sum(ead), 2) AS ead,
  round(sum(risk_weight * ead) / sum(ead), 8) AS rwa_density FROM tape"""
    q["ecl_by_stage"] = f"""{_TAPE} SELECT ifrs9_stage, count(*) AS loan_count, round(sum(ead), 2) AS ead,
  round(sum({_EL}), 2) AS ecl, round(sum({_EL}) / sum(ead), 8) AS coverage FROM tape GROUP BY 1"""
    q["vintage_trend"] = f"""{_TAPE}, g AS (SELECT CAST({year} AS INT) AS vintage, count(*) AS loan_count,
  sum(current_balance) AS e, sum(pd_12m * current_balance) / sum(current_balance) AS p,
  sum(({_LTV}) * current_balance) / sum(current_balance) AS l,
  CAST(count(*) FILTER (WHERE nhg_flag) AS DOUBLE) / count(*) AS n FROM tape GROUP BY 1)
SELECT vintage, loan_count, round(e, 2) AS exposure, round(p, 8) AS weighted_pd_12m,
  round(l, 8) AS weighted_ltv, round(n, 8) AS nhg_share,
  round(p - lag(p) OVER (ORDER BY vintage), 8) AS pd_change,
  round(l - lag(l) OVER (ORDER BY vintage), 8) AS ltv_change FROM g"""
    q["roll_rate"] = f"""{_NEXT}, g AS (SELECT a.arrears_bucket AS from_bucket, b.arrears_bucket AS to_bucket,
  count(*) AS loan_count, round(sum(a.current_balance), 2) AS exposure
  FROM tape a JOIN next_tape b ON a.loan_id = b.loan_id GROUP BY 1, 2)
SELECT *, round(loan_count / CAST(sum(loan_count) OVER (PARTITION BY from_bucket) AS DOUBLE), 8)
  AS roll_rate FROM g"""

    # significant increase in credit risk
    q["sicr_triggers"] = f"""{_TAPE}{_SICR} SELECT loan_id, q AS sicr_quant_pd_increase,
  d AS sicr_dpd_30_backstop, f AS sicr_forbearance, w AS sicr_watchlist, m AS sicr_macro_overlay,
  c AS sicr_climate_transition,
  concat_ws(',', CASE WHEN q THEN 'QUANT_PD_INCREASE' END, CASE WHEN d THEN 'DPD_30_BACKSTOP' END,
    CASE WHEN f THEN 'FORBEARANCE' END, CASE WHEN w THEN 'WATCHLIST' END,
    CASE WHEN m THEN 'MACRO_OVERLAY' END, CASE WHEN c THEN 'CLIMATE_TRANSITION' END) AS sicr_reasons,
  derived_stage FROM staged"""
    q["sicr_trigger_counts"] = f"""{_TAPE}{_SICR} """ + " UNION ALL ".join(
        f"SELECT '{name}' AS trigger, CAST(count(*) FILTER (WHERE {flag}) AS BIGINT) AS loan_count"
        " FROM hits"
        for name, flag in (
            ("QUANT_PD_INCREASE", "q"), ("DPD_30_BACKSTOP", "d"), ("FORBEARANCE", "f"),
            ("WATCHLIST", "w"), ("MACRO_OVERLAY", "m"), ("CLIMATE_TRANSITION", "c"),
        )
    )
    q["stage_transition"] = f"""{_TAPE}{_SICR} SELECT ifrs9_stage AS reported_stage, derived_stage,
  {_EXPOSURE} FROM staged GROUP BY 1, 2"""
    q["sicr_quality"] = f"""{_TAPE}{_SICR}, e AS (SELECT sicr_trigger_reason <> 'NONE' AS e,
  derived_stage >= '2' AS p FROM staged)
SELECT round(CAST(count(*) FILTER (WHERE e AND p) AS DOUBLE) / count(*) FILTER (WHERE e), 8) AS recall,
  round(CAST(count(*) FILTER (WHERE NOT e AND NOT p) AS DOUBLE) / count(*) FILTER (WHERE NOT e), 8)
    AS specificity FROM e"""

    # stress
    q["stress_house_price"] = _stress("{pd}", _HOUSE)
    q["stress_energy"] = _stress("{pd}", _ENERGY)
    q["stress_hra"] = _stress(_HRA_COST, "lgd")
    q["stress_rate_reset"] = _stress(_RESET_COST, "lgd")
    q["stress_check"] = _stress("{pd}", _HOUSE).split("SELECT ifrs9_stage AS segment")[0] + """
SELECT round(sum(base_el), 2) AS base_el, round(sum(stressed_el), 2) AS stressed_el,
  round(sum(stressed_el) - sum(base_el), 2) AS el_delta, CAST(0 AS BIGINT) AS non_finite,
  CASE WHEN abs(sum(stressed_el) - sum(base_el)) > 3 * 1e7 THEN 'FAILED' ELSE 'OK' END AS status
FROM stressed"""

    q["loss_bridge"] = _bridge()
    q["loss_bridge_failing"] = _bridge("CASE WHEN CAST(substr(loan_id, 4, 9) AS BIGINT) % 50 <> 0 THEN lgd END")

    # drift and anomalies
    q["ks_drift"] = _ks()
    q["anomaly_rules"] = _outliers()
    q["repayment_mix_anomaly"] = f"""{_TAPE}, g AS (SELECT CAST({year} AS INT) AS vintage,
  count(*) AS loan_count,
  CAST(count(*) FILTER (WHERE repayment_type = 'AFLOSSINGSVRIJ') AS DOUBLE) / count(*) AS share
  FROM tape GROUP BY 1),
o AS (SELECT a.vintage, any_value(a.loan_count) AS loan_count, any_value(a.share) AS share,
  avg(b.share) AS m, stddev_samp(b.share) AS s FROM g a JOIN g b ON a.vintage <> b.vintage GROUP BY 1)
SELECT vintage, loan_count, round(share, 8) AS share, round(m, 8) AS mean_others, round(s, 8) AS sd_others,
  round((share - m) / s, 5) AS z_score, abs((share - m) / s) > 2 AS is_anomaly FROM o"""

    # gates
    critical = " OR ".join(f"({c})" for c, s, _ in _RULES.values() if s == "CRITICAL")
    q["stage_gate"] = f"""{_TAPE}{_CHECKED},
i AS (SELECT count(*) AS n, CAST(count(*) FILTER (WHERE NOT is_valid) AS BIGINT) AS hit FROM flagged),
c AS (SELECT count(*) AS n, CAST(count(*) FILTER (WHERE {critical}) AS BIGINT) AS hit FROM valid)
SELECT 'ingest' AS stage, CASE WHEN hit > 0 THEN 'FAILED' ELSE 'OK' END AS status,
  n AS checked_count, hit AS flagged_count FROM i
UNION ALL SELECT 'validation', CASE WHEN hit > n * 1e-2 THEN 'BLOCKED' ELSE 'OK' END, n, hit FROM c
UNION ALL SELECT 'anacredit', 'OK', n, CAST(0 AS BIGINT) FROM c
UNION ALL SELECT 'quick_scan', 'OK', CAST(8 AS BIGINT), CAST(0 AS BIGINT)"""
    number = "CAST(substr(loan_id, 4, 9) AS BIGINT)"
    broken = _TAPE.replace("tape AS", "clean AS") + f""", tape AS (SELECT * REPLACE (
  CASE WHEN {number} % 50 = 0 THEN 15e-1 ELSE lgd END AS lgd,
  CASE WHEN {number} % 50 = 0 THEN CAST('nan' AS DOUBLE) ELSE pd_12m END AS pd_12m,
  CASE WHEN {number} % 50 = 0 THEN CAST('nan' AS DOUBLE) ELSE pd_lifetime END AS pd_lifetime,
  {number} % 20 = 1 OR nhg_flag AS nhg_flag,
  CASE WHEN {number} % 20 = 1 THEN 1e0 ELSE nhg_cap_at_origination END AS nhg_cap_at_origination,
  CASE WHEN {number} % 30 = 2 THEN ' ' ELSE borrower_id END AS borrower_id) FROM clean)"""
    empty = " OR ".join(f"{name} IS NULL OR CAST({name} AS VARCHAR) = ''" for name in REQUIRED_ATTRIBUTES)
    scan = re.sub(r"^.*?SELECT count\(\*\) AS loan_count,\s*count\(DISTINCT borrower_id\) AS borrower_count,", "SELECT ",
                  q["quick_scan_kpis"][len(_TAPE):], flags=re.DOTALL)
    q["gates_failing"] = f"""{broken}{_CHECKED}, a AS ({_ATTRIBUTES}), kpis AS ({scan}),
g AS (SELECT 'ingest' AS stage, 'FAILED' AS bad, count(*) AS n, count(*) FILTER (WHERE NOT is_valid) AS hit, 0 AS free FROM flagged
UNION ALL SELECT 'validation', 'BLOCKED', count(*), count(*) FILTER (WHERE {critical}), count(*) * 1e-2 FROM valid
UNION ALL SELECT 'anacredit', 'WARNING', count(*), count(*) FILTER (WHERE {empty}), 0 FROM a
UNION ALL SELECT 'quick_scan', 'FAILED', count(*), count(*) FILTER (WHERE v IS NULL OR NOT isfinite(v)), 0
  FROM (SELECT unnest([{', '.join(_INDICATORS)}]) AS v FROM kpis)
UNION ALL SELECT 'stress', 'FAILED', count(*), count(*) FILTER (WHERE el IS NULL OR NOT isfinite(el)), 0
  FROM (SELECT (CASE WHEN ifrs9_stage = '1' THEN pd_12m ELSE pd_lifetime END) * ({_HOUSE}) * ead AS el FROM tape))
SELECT stage, CASE WHEN hit > free THEN bad ELSE 'OK' END AS status, n AS checked_count, CAST(hit AS BIGINT) AS flagged_count FROM g
UNION ALL SELECT 'anomaly', 'DEGRADED', count(*), NULL FROM tape"""
    q["income_bands_asof"] = f"""{_TAPE},
loans AS (SELECT loan_id, CAST(year(origination_date) AS INT) AS year, gross_household_income AS income, {number} AS k FROM tape),
bands AS (SELECT year AS y, income AS start, max(CAST(CAST(floor(income / 1000) AS BIGINT) % 7 + 3 AS DOUBLE)) AS factor
  FROM loans WHERE k % 3 = 0 GROUP BY ALL),
firsts AS (SELECT y, arg_min(factor, start) AS factor FROM bands GROUP BY y)
SELECT l.loan_id, l.year, l.income, coalesce(b.factor, f.factor) AS factor
FROM loans l ASOF LEFT JOIN bands b ON l.year = b.y AND l.income >= b.start LEFT JOIN firsts f ON f.y = l.year"""
    q["load_csv_values"] = f"""{_TAPE} SELECT loan_id, origination_date, current_balance, bouwjaar, tax_deduction_eligible,
  rentevast_einddatum, CASE WHEN {number} % 3 = 0 THEN 'first "line"' || chr(10) || loan_id || ',' || chr(10) || chr(10) || 'last'
  ELSE gemeente END AS remark FROM tape"""
    q["store_versions"] = f"""{_TAPE} SELECT loan_id, ifrs9_stage, current_balance, CAST(1 AS BIGINT) AS version FROM tape
UNION ALL SELECT loan_id, ifrs9_stage, current_balance, CAST(2 AS BIGINT) FROM tape WHERE ifrs9_stage = '2'"""
    snapshots = " UNION ALL ".join(
        f"""SELECT loan_id, DATE '{y}-06-01' AS seen, pd_lifetime * (25e-2 + ({number} + {y}) % 5) AS pd_lifetime,
  ({number} * 7 + {y * 3}) % 11 >= 7 AS restructured, CASE WHEN ({number} * 7 + {y * 3}) % 11 = 3 THEN 120 ELSE days_past_due END >= 90
  OR unlikely_to_pay_flag OR ({number} * 7 + {y * 3}) % 11 = 3 AS defaulted FROM tape WHERE {number} % 4 <= {y - 2022}"""
        for y in (2022, 2023, 2024, 2025))
    q["origination_pd"] = f"""{_TAPE}, snapshots AS ({snapshots}),
first AS (SELECT loan_id, arg_min(pd_lifetime, seen) AS pd FROM snapshots GROUP BY loan_id)
SELECT t.loan_id, pd AS pd_lifetime_at_origination,
  CASE WHEN pd IS NULL THEN NULL ELSE t.pd_lifetime > 25e-1 * pd AND t.pd_lifetime - pd > 5e-3 END AS sicr_quant_pd_increase
FROM tape t LEFT JOIN first f USING (loan_id)"""
    island = """SELECT loan_id, min(seen) AS spell_start, max(seen) AS spell_end FROM (
  SELECT loan_id, seen, {c}, row_number() OVER (PARTITION BY loan_id ORDER BY seen)
    - row_number() OVER (PARTITION BY loan_id, {c} ORDER BY seen) AS island FROM snapshots) WHERE {c} GROUP BY loan_id, island"""
    q["credit_events"] = f"""{_TAPE}, snapshots AS (SELECT * FROM ({snapshots}) WHERE seen <= {_REF}),
r AS (SELECT loan_id, max(spell_start) AS restructure_date FROM ({island.format(c='restructured')}) GROUP BY loan_id),
seen AS (SELECT loan_id, max(seen) AS last_seen FROM snapshots GROUP BY loan_id),
d AS (SELECT loan_id, spell_start AS date_of_default FROM ({island.format(c='defaulted')}) JOIN seen USING (loan_id) WHERE spell_end = last_seen)
SELECT loan_id, restructure_date, coalesce({_REF} <= restructure_date + INTERVAL 24 MONTH, false) AS forborne, date_of_default
FROM r FULL JOIN d USING (loan_id)"""
    listed = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in (*COLUMNS, "easter_egg"))
    q["tape_difference"] = f"""{_NEXT},
later AS (SELECT * FROM next_tape WHERE {number} % 97 <> 0),
after AS (SELECT * FROM later UNION ALL SELECT * FROM later WHERE {number} % 89 = 0
  UNION ALL SELECT * REPLACE (loan_id || '-N' AS loan_id) FROM tape WHERE {number} % 101 = 0),
gone AS (SELECT *, count(*) AS copies FROM (SELECT * FROM tape EXCEPT ALL SELECT * FROM after) GROUP BY ALL),
come AS (SELECT *, count(*) AS copies FROM (SELECT * FROM after EXCEPT ALL SELECT * FROM tape) GROUP BY ALL),
paired AS (SELECT o.loan_id, o.copies, concat_ws(',', {listed}) AS changed_columns FROM gone o JOIN come n
  ON o.loan_id = n.loan_id AND o.copies = n.copies)
SELECT loan_id, 'changed' AS change, copies, changed_columns FROM paired
UNION ALL SELECT loan_id, 'removed', copies, NULL FROM gone WHERE loan_id NOT IN (SELECT loan_id FROM paired)
UNION ALL SELECT loan_id, 'added', copies, NULL FROM come WHERE loan_id NOT IN (SELECT loan_id FROM paired)"""
    q["run_ledger"] = f"""WITH g AS ({q['stage_gate']})
SELECT 'run-1' AS run_id, 'driver' AS tape_id, stage, status, checked_count, flagged_count,
  {_REF} AS reference_date FROM g"""
    q["ledger_after_retry"] = f"""WITH g AS ({q['stage_gate']}), i AS ({q['first_issues']}),
p AS (SELECT CAST(to_json(list({{'loan_id': loan_id, 'field': field, 'code': code}} ORDER BY loan_id)) AS VARCHAR) AS shown FROM i)
SELECT run_id, 'driver' AS tape_id, stage, status, checked_count, flagged_count, {_REF} AS reference_date,
  CASE WHEN stage = 'ingest' AND status <> 'OK' THEN shown END AS error_payload
FROM g, p, (VALUES ('run-1'), ('run-2')) r(run_id)"""
    q |= source_oracle.oracles(_TAPE, _CROSS, _CAPS, _HRA, COLUMNS, q["first_issues"])
    return q

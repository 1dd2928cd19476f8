"""The loan tape derived from the ``orders`` and ``customer`` test tables.

One order is one loan and its customer the borrower. The text uses only
functions that give equal results in Spark SQL and DuckDB, so the same common
table expressions serve the queries and their SQL counterparts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from polderbook.model import (
    BORROWER_TYPES, ENERGY_LABELS, LABELLED_SCHEMA, PROPERTY_TYPES, RATE_TYPES, REPAYMENT_TYPES, SCORE_BANDS,
    SICR_REASONS, VALUATION_TYPES,
)
from polderbook.sources.reference_tables import HRA_RATES, NHG_CAPS
from polderbook.sources.shared import working_folder

def _pick(values: tuple[str, ...], number: str) -> str:
    """SQL text that takes one of ``values`` by a number, each equally often."""
    return f"split_part('{','.join(values)}', ',', CAST(1 + {number} % {len(values)} AS INT))"


def _by_year(table: dict[int, float], year: str) -> str:
    cases = " ".join(f"WHEN {y} THEN {float(v)!r}e0" for y, v in sorted(table.items()))
    return f"CASE {year} {cases} END"


YEARS = range(2010, 2026)
AREAS = ("1602 Enkhuizen", "3861 Nijkerk", "4461 Goes", "5961 Horst", "6811 Arnhem", "7201 Zutphen", "8601 Sneek", "9401 Assen")
# Every defect sits on the orders whose key this divides.
DEFECTS = {
    "balance": 103, "nhg_cap": 107, "interest_only": 109, "value": 113, "income": 127, "valuation": 131,
    "tax_type": 137, "currency": 139, "postcode": 149, "lifetime": 151, "maturity": 157, "tax_year": 163,
    "backstop": 167, "label": 173, "lgd": 179, "score": 181, "bullet": 191,
}


def _tape_ctes(orders: str, join: str, customer: str) -> str:
    hit = {name: f"k % {every} = 0" for name, every in DEFECTS.items()}
    return f"""
drawn AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_totalprice + 40000 AS prin,
    CAST(month(o_orderdate) AS INT) AS mo, CAST(least(day(o_orderdate), 28) AS INT) AS dy,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS pr,
    CAST({YEARS.start} + (o_orderkey * 5 + o_custkey) % {len(YEARS)} AS INT) AS yr,
    CAST((o_orderkey * 37 + o_custkey * 11) % 997 AS INT) AS a, CAST((o_orderkey * 53 + o_custkey * 7) % 991 AS INT) AS b,
    CAST((o_orderkey * 71 + o_custkey * 3) % 983 AS INT) AS d, CAST((o_orderkey * 89 + 5) % 977 AS INT) AS e
  FROM {orders} {join} {customer} ON o_custkey = c_custkey
),
chosen AS (
  SELECT *, make_date(yr, mo, dy) AS opened, prin * (13e-1 + b % 50 * 10137e-6) AS worth,
    CASE WHEN {hit['bullet']} OR {hit['tax_type']} THEN 'AFLOSSINGSVRIJ' WHEN {hit['tax_year']} THEN 'LINEAIR'
      ELSE {_pick(REPAYMENT_TYPES, 'a')} END AS repays,
    {_pick(RATE_TYPES, 'b')} AS fixes,
    CASE WHEN {hit['backstop']} THEN '3' WHEN d % 20 = 0 THEN '3' WHEN d % 20 < 3 THEN '2' ELSE '1' END AS stage,
    {_by_year(NHG_CAPS, 'yr')} AS cap, {_by_year({y: HRA_RATES[max(y, 2013)] for y in YEARS}, 'yr')} AS relief
  FROM drawn
),
arrears AS (
  SELECT *,
    CASE WHEN {hit['backstop']} THEN 7 WHEN stage = '3' THEN 95 + e % 200 WHEN stage = '2' THEN e % 88 ELSE 0 END AS late,
    CASE WHEN {hit['balance']} THEN prin * 12e-1 ELSE prin * (1 - (2025 - yr) * 1937e-5) END AS owed,
    CASE WHEN {hit['income']} THEN prin / 9 ELSE prin / (25e-1 + e % 20 * 1e-1) END AS income,
    (prin <= cap AND pr <= 3) OR {hit['nhg_cap']} AS insured,
    CASE WHEN {hit['score']} THEN NULL ELSE {_pick(SCORE_BANDS, 'e')} END AS band,
    1e-3 + a * 2e-5 AS pd
  FROM chosen
),
tape AS (
  SELECT
    'LN-' || lpad(CAST(k AS STRING), 9, '0') AS loan_id,
    'BO-' || lpad(CAST(c AS STRING), 8, '0') AS borrower_id,
    {_pick(BORROWER_TYPES, 'e')} AS borrower_type,
    opened AS origination_date,
    CASE WHEN {hit['maturity']} THEN opened ELSE make_date(yr + 20 + pr * 2, mo, dy) END AS maturity_date,
    prin AS original_principal,
    owed AS current_balance,
    15e-3 + b * 3e-5 AS interest_rate,
    fixes AS rate_type,
    CASE WHEN fixes <> 'VARIABEL' THEN make_date(yr + pr * 4, mo, dy) END AS rentevast_einddatum,
    repays AS repayment_type,
    (repays IN ('ANNUITEIT', 'LINEAIR') AND yr >= 2013) OR {hit['tax_type']} OR {hit['tax_year']} AS tax_deduction_eligible,
    relief AS hra_phase_out_rate,
    CASE WHEN {hit['interest_only']} THEN worth * 85e-2 WHEN repays = 'AFLOSSINGSVRIJ' THEN worth * 4e-1
      WHEN repays = 'HYBRIDE' THEN worth * 2e-1 ELSE 0e0 END AS interest_only_portion,
    CASE WHEN {hit['currency']} THEN 'GBP' ELSE 'EUR' END AS currency,
    worth AS property_value_at_origination,
    worth * 98e-2 AS taxatie_waarde,
    CASE WHEN {hit['valuation']} THEN make_date(yr - 6, mo, dy) ELSE make_date(2024, mo, dy) END AS taxatie_date,
    {_pick(VALUATION_TYPES, 'd')} AS taxatie_type,
    worth * 9e-1 AS woz_waarde,
    make_date(least(yr + 1, 2025), 1, 1) AS woz_reference_date,
    CASE WHEN {hit['value']} THEN 0e0 ELSE worth * (1 + (2025 - yr) * 2113e-5) END AS property_value_current,
    CASE WHEN {hit['postcode']} THEN '16o2xy' ELSE substr({_pick(AREAS, 'c')}, 1, 4) || chr(65 + a % 26) || chr(65 + b % 26) END AS pc6,
    substr({_pick(AREAS, 'c')}, 6) AS gemeente,
    {_pick(PROPERTY_TYPES, 'a')} AS property_type,
    1930 + d % 90 AS bouwjaar,
    CASE WHEN {hit['label']} THEN 'H' ELSE {_pick(ENERGY_LABELS, 'd')} END AS energy_label,
    insured AS nhg_flag,
    CASE WHEN {hit['nhg_cap']} THEN prin * 7e-1 ELSE cap END AS nhg_cap_at_origination,
    CASE WHEN insured THEN 750e0 + pr ELSE 0e0 END AS nhg_premium_paid,
    pd AS pd_12m,
    CASE WHEN {hit['lifetime']} THEN pd / 2 ELSE pd * (2 + pr) END AS pd_lifetime,
    CASE WHEN {hit['lgd']} THEN 135e-2 ELSE 5e-2 + e * 2e-4 END AS lgd,
    owed AS ead,
    stage AS ifrs9_stage,
    CASE stage WHEN '1' THEN 'NONE' WHEN '2' THEN {_pick(SICR_REASONS[1:], 'a')} ELSE 'DPD_30_BACKSTOP' END AS sicr_trigger_reason,
    late AS days_past_due,
    CASE WHEN late = 0 THEN '0' WHEN late <= 30 THEN '1-30' WHEN late <= 60 THEN '31-60' WHEN late < 90 THEN '61-90'
      ELSE '90+' END AS arrears_bucket,
    stage <> '1' AND e % 4 = 0 AND NOT ({hit['backstop']}) AS restructured_flag,
    stage = '2' AND a % 5 = 0 AS watchlist_flag,
    stage = '3' AND b % 3 = 0 AND NOT ({hit['backstop']}) AS unlikely_to_pay_flag,
    CASE WHEN insured THEN 1e-1 ELSE 2e-1 + pr * 5e-2 END AS risk_weight,
    income AS gross_household_income,
    a % 2 = 0 AS partner_income_included,
    CAST(d % 10 * 2500 AS DOUBLE) AS student_loan_debt,
    band AS bkr_score_band,
    coalesce(band = 'E', false) AS bkr_negative_registration_flag,
    11e-1 + e * 2e-3 AS dscr,
    CASE WHEN {hit['nhg_cap']} THEN 'NHG_CAP_BREACH_BATCH' WHEN {hit['interest_only']} THEN 'HIGH_INTEREST_ONLY_CLUSTER'
      WHEN {hit['valuation']} THEN 'STALE_TAXATIE_CLUSTER' WHEN {hit['bullet']} THEN 'HIGH_AFLOSSINGSVRIJ_COHORT' END
      AS easter_egg
  FROM arrears
)
"""

# A tape one month later: some loans cured, some rolled forward, some repaid.
_MOVED = {
    "days_past_due": "dpd2",
    "arrears_bucket":
        "CASE WHEN dpd2 = 0 THEN '0' WHEN dpd2 <= 30 THEN '1-30' WHEN dpd2 <= 60 THEN '31-60'"
        " WHEN dpd2 < 90 THEN '61-90' ELSE '90+' END",
    "current_balance": "CASE WHEN k % 11 = 0 THEN current_balance * 9e-1 ELSE current_balance END",
    "pd_12m": "CASE WHEN k % 5 = 0 THEN pd_12m * 15e-1 ELSE pd_12m END",
}
_NEXT_TAPE_CTE = f"""
moved AS (
  SELECT *, CAST(substr(loan_id, 4) AS BIGINT) AS k FROM tape
),
next_dpd AS (
  SELECT *,
    CASE WHEN k % 7 = 0 THEN 0 WHEN days_past_due > 0 THEN days_past_due + 30
         WHEN k % 31 = 0 THEN 15 ELSE 0 END AS dpd2
  FROM moved WHERE k % 53 <> 0
),
next_tape AS (
  SELECT {', '.join(f"{_MOVED[c]} AS {c}" if c in _MOVED else c for c in LABELLED_SCHEMA.names)}
  FROM next_dpd
)
"""


def oracle_prefix(next_tape: bool = False) -> str:
    """``WITH`` clause that defines ``tape`` (and ``next_tape``) over plain table names."""
    ctes = _tape_ctes("orders", "JOIN", "customer").strip()
    return "WITH " + ctes + ("," + _NEXT_TAPE_CTE if next_tape else "\n")


#: All that the tape takes from orders.
_READ = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def derive_tape(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The tape as a lazy projection of orders; ``spread`` deals the few columns read evenly over the tasks first.

    Customers only confirm that a loan has a borrower: a semi join reads the one
    key column, keeps the big side split by AQE when a key is hot, and is
    broadcast only when Spark's own size estimate allows it.
    """
    ctes = _tape_ctes("{orders}", "LEFT SEMI JOIN", "{customer}")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(*_READ)
    return spark.sql(
        f"WITH {ctes.strip()} SELECT * FROM tape",
        orders=orders.hint("rebalance", "o_orderkey") if spread else orders,
        customer=spark.read.parquet(f"{sf_dir}/customer.parquet"),
    )


_WRITTEN: dict[tuple[str, str], str] = {}


def tape_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived tape as the operators meet it in practice: a Parquet table.

    It is written once per session and folder by a map-only job after the five columns
    read were dealt (and the semi join); the wide rows are not shuffled. So each query scans just the columns it needs and pushes its filters
    to the reader instead of recomputing the projection under every predicate.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _WRITTEN:
        path = working_folder(spark, "tape")
        # Files of even size, as many as the session has cores or the size asks for.
        derive_tape(spark, sf_dir, spread=True).write.option("compression", "zstd").parquet(path)
        _WRITTEN[key] = path
    return spark.read.schema(LABELLED_SCHEMA).parquet(_WRITTEN[key])


def next_tape_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later snapshot of the same loans with the columns that move."""
    return spark.sql(
        "WITH " + _NEXT_TAPE_CTE.replace("FROM tape", "FROM {tape}") + " SELECT * FROM next_tape",
        tape=tape_view(spark, sf_dir),
    )

from __future__ import annotations

import pytest

from polderbook.model import FIELDS
from polderbook.plans import oracle, source_queries
from polderbook.plans.tape_view import tape_view
from polderbook.session import tune
from tests.oracle_check import compare, connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tape(spark):
    return tape_view(tune(spark), SF_DIR)


@pytest.fixture(scope="module")
def duck():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(source_queries.QUERIES))
def test_equals_its_sql(tape, duck, name):
    assert name in oracle.oracles()
    assert compare(source_queries.QUERIES[name](tape), duck, name) is None


def test_every_column_is_spoiled_and_reported(tape):
    found = {r["field"] for r in source_queries.QUERIES["violations_all_columns"](tape).select("field").distinct().collect()}
    optional = {f.name for f in FIELDS if f.nullable}
    assert {f.name for f in FIELDS} - optional <= found


def test_unreadable_text_is_reported_for_every_typed_column(tape):
    rows = source_queries.QUERIES["violations_text_tape"](tape).where("code LIKE '%_parsing'").select("field").distinct().collect()
    assert {r["field"] for r in rows} == {f.name for f in FIELDS if f.kind not in ("string", "enum")}


def test_strict_load_lists_the_first_loans(tape):
    parquet = source_queries.QUERIES["load_parquet_strict"](tape).collect()
    assert 0 < len(parquet) <= 10
    assert [r["loan_id"] for r in parquet] == sorted(r["loan_id"] for r in parquet)
    assert source_queries.QUERIES["load_csv_strict"](tape).collect() == parquet


def test_text_values_are_parsed_once(tape):
    """Every parsed column has one pattern match in the plan, not one in each of its tests."""
    found = source_queries.QUERIES["violations_text_tape"](tape)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("RLIKE") <= len(FIELDS)

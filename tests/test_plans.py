"""Plan shape of the operators and agreement of every query with its SQL."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from polderbook.operators import anacredit, kpis, rules, sicr, stress, validation
from polderbook.plans import oracle
from polderbook.plans import queries as registry
from polderbook.plans.tape_view import tape_view
from polderbook.sources import store
from tests.oracle_check import compare, connection
from tests.rows import REFERENCE_DATE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.fixture(scope="module")
def view(spark):
    return tape_view(spark, SF)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


#: The forest is random and the observed gates depend on it; both have tests of their own.
WITHOUT_SQL = {"anomaly_forest", "gates_observed"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - WITHOUT_SQL))
def test_query_agrees_with_sql(spark, con, name):
    frame = registry.queries()[name](spark, SF)
    # No Python in the tasks and no pairing of everything with everything.
    assert not re.search(
        r"Python|ArrowEval|MapInPandas|CartesianProduct|NestedLoop", plan(frame)
    )
    assert compare(frame, con, name) is None


def test_every_other_query_has_sql():
    assert set(registry.queries()) - WITHOUT_SQL == set(oracle.oracles())


def test_entry(spark):
    assert driver.entry(spark).count() == 1


def test_row_operators_do_not_shuffle(view):
    for frame in (
        validation.valid_loans(view), validation.with_validity(view),
        validation.schema_violations(view), rules.run_all_rules(view, REFERENCE_DATE),
        rules.rule_flags(view, REFERENCE_DATE), anacredit.map_tape(view),
        anacredit.check_conformance(anacredit.map_tape(view, "skip")),
        sicr.sicr_triggers(view, REFERENCE_DATE), stress.house_price_shock(view, -0.1),
    ):
        assert "Exchange" not in plan(frame)


def test_filters_and_columns_reach_the_reader(view):
    text = plan(store.by_stage(view, "2").select("loan_id", "ead"))
    assert "EqualTo(ifrs9_stage,2)" in text
    assert re.search(r"ReadSchema: struct<loan_id:string,ead:double,ifrs9_stage:string>", text)
    assert "PartitionFilters: []" in text
    trend = plan(kpis.vintage_histogram(view))
    assert "ReadSchema: struct<origination_date:date>" in trend
    # The full list of pushed filters is cut short in the compact plan text.
    mode = view.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    valid = validation.valid_loans(view)._jdf.queryExecution()
    assert "GreaterThanOrEqual(ead,0.0)" in valid.explainString(mode.fromString("formatted"))


def test_counts_shuffle_one_row_per_task(view):
    text = plan(rules.rule_counts(view, REFERENCE_DATE))
    assert text.count("Exchange") == 1 and "SinglePartition" in text


def test_drift_reads_each_snapshot_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(driver.queries()["ks_drift"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("FileScan") == 2 and "ReusedExchange" in text


def test_drift_places_values_once(spark):
    """Values meet their bin edges in one join; bins are accumulated without going back to the values."""
    text = driver.queries()["ks_drift"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join ") == 1


def test_valid_row_filter_stays_compilable(view):
    """The fused row test must stay below the size that the JVM compiles."""
    stages = validation.valid_loans(view)._jdf.queryExecution().debug().codegenToSeq().iterator()
    sizes = []
    while stages.hasNext():
        sizes.append(stages.next()._3().maxMethodCodeSize())
    assert sizes and max(sizes) < 8000


def test_tape_is_written_without_a_shuffle_of_wide_rows(spark, tmp_path):
    from polderbook.model import LABELLED_SCHEMA
    from polderbook.plans import tape_view

    spark.range(50).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "id * 1e3 AS o_totalprice", "DATE '2020-02-29' + CAST(id AS INT) AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", "'x' AS o_comment").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(5).selectExpr("id AS c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    spread = tape_view.derive_tape(spark, str(tmp_path), spread=True)
    dealt = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions [o_orderkey" in dealt
    below = dealt[dealt.index("RebalancePartitions"):]
    assert "o_comment" not in below.split("Relation")[0] and "loan_id" not in below and "LN-" not in below
    whole = tape_view.derive_tape(spark, str(tmp_path)).collect()
    assert sorted(map(str, spread.collect())) == sorted(map(str, whole)) and len(whole) == 36
    written = tape_view.tape_view(spark, str(tmp_path))
    assert written.columns == LABELLED_SCHEMA.names and sorted(map(str, written.collect())) == sorted(map(str, whole))

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from polderbook.functions.lookups import hra_rate_for, nhg_cap_for, nibud_factor
from polderbook.model import COLUMNS
from polderbook.sources import reader, reference_tables
from polderbook.sources.store import TapeStore, VersionConflict
from tests.rows import LOAN, cases, loan


def write_csv(path, rows, header=COLUMNS):
    lines = [",".join(header)]
    for r in rows:
        lines.append(",".join("" if r.get(c) is None else str(r[c]) for c in header))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_missing_path_and_suffix(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        reader.load_tape(spark, tmp_path / "absent.parquet")
    (tmp_path / "tape.xlsx").write_text("x")
    with pytest.raises(ValueError, match="Unsupported"):
        reader.load_tape(spark, tmp_path / "tape.xlsx")


def test_parquet_round_trip(spark, tmp_path):
    frame = cases(spark, {}, {"pc6": "9999ZZ"})
    reader.write_tape_file(frame, tmp_path / "a" / "tape.PARQUET")
    result = reader.load_tape(spark, tmp_path / "a" / "tape.PARQUET", strict=True)
    assert result.row_count == 2 and result.issue_list() == []
    assert result.tape.exceptAll(frame).count() == 0 and frame.exceptAll(result.tape).count() == 0


def test_strict_load_reports_the_first_ten_rows_in_file_order(spark, tmp_path):
    rows = spark.range(15).coalesce(1).select(
        F.format_string("LN-%03d", 15 - F.col("id")).alias("loan_id"))
    rows.write.parquet(str(tmp_path / "bad.parquet"))
    result = reader.load_tape(spark, tmp_path / "bad.parquet", strict=True, max_issues=10)
    issues = result.issue_list()
    assert [i.row_index for i in issues] == list(range(10))
    assert {i.field for i in issues} == {"borrower_id"} and all(i.message for i in issues)
    assert result.issues.first()["loan_id"] == "LN-015"


def test_loose_load_checks_nothing(spark, tmp_path):
    spark.createDataFrame([("a", 1), ("b", 2)], "loan_id string, garbage int").write.parquet(
        str(tmp_path / "raw.parquet"))
    result = reader.load_tape(spark, tmp_path / "raw.parquet")
    assert result.row_count == 2 and result.issue_list() == []
    assert result.tape.columns == ["loan_id", "garbage"]


def test_csv_types_and_issues(spark, tmp_path):
    rows = [loan(1), loan(2, lgd=2.0), loan(3, rentevast_einddatum=None), loan(4, bouwjaar="old")]
    write_csv(tmp_path / "tape.csv", rows)
    result = reader.load_tape(spark, tmp_path / "tape.csv", strict=True)
    got = {r["loan_id"]: r for r in result.tape.collect()}
    first = got["LN-0000001"]
    assert first["origination_date"] == LOAN["origination_date"] and first["ifrs9_stage"] == "1"
    assert first["tax_deduction_eligible"] is True and first["bouwjaar"] == LOAN["bouwjaar"]
    assert got["LN-0000003"]["rentevast_einddatum"] is None
    assert [(i.row_index, i.field) for i in result.issue_list()] == [(1, "lgd"), (3, "bouwjaar")]


def test_csv_row_numbers_across_file_blocks(spark, tmp_path):
    bad = {7, 350, 351, 799}
    rows = [loan(i, lgd=2.0 if i in bad else 0.1) for i in range(800)]
    write_csv(tmp_path / "tape.csv", rows)
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, x in keys.items():
            spark.conf.set(k, x)
        raw = reader.read_csv(spark, str(tmp_path / "tape.csv"), positions=True)
        assert raw.select("__block").distinct().count() > 3
        issues = reader.csv_issues(raw).collect()
        assert [r["row_index"] for r in issues] == sorted(bad)
        assert [int(r["loan_id"][3:]) for r in issues] == sorted(bad)
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


@pytest.mark.parametrize("split", [1, 7, 64, 1000, 1 << 20])
def test_csv_records_with_line_breaks_at_any_split(spark, tmp_path, split):
    import csv

    texts = ["plain", "two\nlines", 'a "quoted" word', "", "x\n\n\"\n,y", "crlf\r\nhere", "\n" * 5, 'ends with "', "é\nü"]
    rows = [(f"LN-{i}", texts[i % len(texts)], str(i)) for i in range(40)]
    folder = tmp_path / "tapes"
    folder.mkdir()
    for name, part in (("a.csv", rows[:25]), ("b.csv", rows[25:])):
        with open(folder / name, "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator="\n" if name == "a.csv" else "\r\n")
            out.writerow(("loan_id", "remark\nof loan", "n"))
            out.writerows(part)
    keys = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        if split > 1:  # a task per byte only tells the same more slowly
            for k, x in keys.items():
                spark.conf.set(k, x)
        raw = reader.read_csv(spark, str(folder), positions=True)
        assert raw.columns[:3] == ["loan_id", "remark\nof loan", "n"]
        got = [tuple(r)[:3] for r in raw.orderBy("__file", "__block", "__row").collect()]
        assert got == [(a, b or None, c) for a, b, c in rows]
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


def test_csv_without_breaks_is_not_shuffled(spark, tmp_path):
    from polderbook.sources import csv_records

    write_csv(tmp_path / "tape.csv", [loan(i) for i in range(20)])
    (tmp_path / "empty.csv").write_text("")
    assert reader.read_csv(spark, str(tmp_path / "tape.csv")).count() == 20
    assert reader.read_csv(spark, str(tmp_path / "empty.csv")).columns == []
    lines = csv_records.records(spark, str(tmp_path / "tape.csv"))
    assert lines.count() == 21


def test_csv_lines_with_breaks_are_joined_without_a_shuffle_of_the_text(spark, tmp_path):
    from polderbook.sources import csv_records

    (tmp_path / "tape.csv").write_text('id,remark\n1,"a\nb"\n2,plain\n3,"c\n\nd"\n', newline="")
    rows = csv_records.records(spark, str(tmp_path / "tape.csv"))
    assert [r["record"] for r in rows.orderBy("__row").collect()] == ["id,remark", '1,"a\nb"', "2,plain", '3,"c\n\nd"']
    text = rows._jdf.queryExecution().executedPlan().toString()
    # only pieces of records that lie in two blocks are dealt, by their file
    assert not re.search(r"Exchange hashpartitioning\(__file#\d+, __block", text)


@pytest.mark.parametrize("size", [1, 2, 3, 100])
def test_csv_pieces_at_the_ends_of_blocks(size):
    import pyarrow as pa

    from polderbook.sources import csv_records

    # (block, line, quotes, whether the block begins inside a value)
    lines = [(0, 'a,"x', 1, 0), (0, 'y"', 1, 0), (0, "b", 0, 0), (0, 'c,"1', 1, 0), (0, "2", 0, 0),
             (9, "3", 0, 1), (9, "4", 0, 1), (20, '5"', 1, 1), (20, "d", 0, 1), (20, 'e,"6', 1, 1), (20, '7"', 1, 1)]
    table = [pa.RecordBatch.from_arrays([
        pa.array(["f"] * len(some)), pa.array([x[0] for x in some], pa.int64()),
        pa.array(range(at, at + len(some)), pa.int64()), pa.array([x[1] for x in some]),
        pa.array([x[2] for x in some], pa.int32()), pa.array([x[3] for x in some], pa.int32())],
        ["__file", "__block", "__row", "value", "quotes", "inside"])
        for at in range(0, len(lines), size) for some in [lines[at:at + size]]]
    got = sorted((r["__block"], r["__row"], r["record"], r["opens"])
                 for b in csv_records._joined(iter(table)) for r in b.to_pylist())
    assert got == [(0, 0, 'a,"x\ny"', None), (0, 2, "b", None), (0, 3, 'c,"1\n2', True), (9, 5, "3\n4", False),
                   (20, 7, '5"', False), (20, 8, "d", None), (20, 9, 'e,"6\n7"', None)]


def test_unknown_csv_column_is_kept_and_reported(spark, tmp_path):
    write_csv(tmp_path / "tape.csv", [{**loan(1), "remark": "x"}], (*COLUMNS, "remark"))
    result = reader.load_tape(spark, tmp_path / "tape.csv", strict=True)
    assert result.tape.first()["remark"] == "x"
    assert [(i.field, i.row_index) for i in result.issue_list()] == [("remark", 0)]


def test_tape_listing(spark, tmp_path):
    assert reader.list_available_tapes(spark, tmp_path / "nothing") == []
    for name in ("b.parquet", "a.parquet"):
        reader.write_tape_file(cases(spark, {}), tmp_path / name)
    (tmp_path / "c.csv").write_text("x")
    assert reader.list_available_tapes(spark, tmp_path) == ["a.parquet", "b.parquet"]
    assert reader.load_named_tape(spark, "a.parquet", tmp_path).count() == 1


def test_payload_drops_the_label(spark):
    frame = cases(spark, {}).withColumn("easter_egg", F.lit("x"))
    assert reader.payload(frame).columns == list(COLUMNS)


def test_store_round_trip_overwrite_and_reopen(spark, tmp_path):
    store = TapeStore(spark, tmp_path / "store")
    assert store.list_tapes() == []
    store.write_tape(cases(spark, {}, {}), "q1")
    store.write_tape(cases(spark, {}), "q2")
    store.write_tape(store.read_tape("q1").limit(1), "q1")  # from its own earlier version
    again = TapeStore(spark, tmp_path / "store")
    assert again.list_tapes() == ["q1", "q2"]
    assert again.read_tape("q1").count() == 1
    assert again.catalog().where("written_at IS NOT NULL").count() == 2
    again.write_tape(cases(spark, {}).limit(0), "empty")
    assert again.read_tape("empty").count() == 0
    assert again.read_tape("empty").columns == list(COLUMNS)
    again.drop()
    assert again.list_tapes() == []


def test_store_readers_are_pinned_and_old_versions_go_after_a_grace_period(spark, tmp_path):
    store = TapeStore(spark, tmp_path / "store")
    assert store.write_tape(cases(spark, {}, {}, {}), "t") == 1
    opened = store.read_tape("t")
    assert store.write_tape(cases(spark, {}), "t") == 2
    assert opened.count() == 3 and store.read_tape("t").count() == 1 and store.read_tape("t", 1).count() == 3
    assert store.vacuum(timedelta(hours=1)) == 0
    later = datetime.now(timezone.utc) + timedelta(hours=2)
    assert store.vacuum(timedelta(hours=1), later) == 1 and store.vacuum(timedelta(hours=1), later) == 0
    assert store.read_tape("t").count() == 1 and store.latest_version("t") == 2
    with pytest.raises(KeyError):
        store.read_tape("t", 1)


def test_store_lets_one_of_two_writers_win(spark, tmp_path):
    store = TapeStore(spark, tmp_path / "store")
    store.write_tape(cases(spark, {}), "t")

    def attempt(rows):
        try:
            return TapeStore(spark, tmp_path / "store").write_tape(cases(spark, *[{}] * rows), "t", after=1)
        except VersionConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        results = list(pool.map(attempt, [2, 3, 4, 5]))
    assert sorted(r for r in results if r) == [2]
    assert store.read_tape("t").count() == [2, 3, 4, 5][results.index(2)]
    assert len(list((tmp_path / "store" / "tapes" / "t").iterdir())) == 2
    assert not [p for p in (tmp_path / "store" / "log" / "t").iterdir() if p.name.endswith(".draft")]


def test_store_errors(spark, tmp_path):
    store = TapeStore(spark, tmp_path / "store")
    with pytest.raises(KeyError, match="not found"):
        store.read_tape("absent")
    for bad in ("a/b", "a\\b"):
        with pytest.raises(ValueError):
            store.write_tape(cases(spark, {}), bad)


def test_store_filters(spark, tmp_path):
    store = TapeStore(spark, tmp_path / "store")
    store.write_tape(cases(
        spark, {"origination_date": date(2015, 1, 1)}, {"origination_date": date(2018, 12, 31)},
        {"origination_date": date(2019, 1, 1), "ifrs9_stage": "2"}), "t")
    assert store.query_by_vintage("t", date(2015, 1, 1), date(2018, 12, 31)).count() == 2
    assert store.query_by_vintage("t", start=date(2018, 12, 31)).count() == 2
    assert store.query_by_vintage("t", end=date(2014, 12, 31)).count() == 0
    assert store.query_by_vintage("t").count() == 3
    assert store.query_by_stage("t", "2").count() == 1
    assert store.query_by_stage("t", "1' OR '1'='1").count() == 0


def test_reference_lookups(spark):
    years = spark.createDataFrame([(y,) for y in (1990, 2010, 2016, 2025, 2031)], "y int")
    caps = [r[0] for r in years.select(nhg_cap_for(F.col("y"))).collect()]
    assert caps == [265000.0, 265000.0, 231132.0, 450000.0, 450000.0]
    rates = [r[0] for r in years.select(hra_rate_for(F.col("y"))).collect()]
    assert rates == pytest.approx([0.52, 0.52, 0.505, 0.3697, 0.3748])
    gap = [r[0] for r in years.select(nhg_cap_for(F.col("y"), {2010: 1.0, 2025: 2.0})).collect()]
    assert gap == [1.0, 1.0, 2.0, 2.0, 2.0]


def test_nibud_bands(spark):
    rows = [(2025, 10000.0, 4.0), (2025, 30000.0, 4.0), (2025, 59999.0, 4.25),
            (2025, 80000.0, 5.25), (2024, 80000.0, 5.0), (2025, 9e6, 4.75), (2020, 5e4, None)]
    frame = spark.createDataFrame([r[:2] for r in rows], "y int, income double")
    got = [r[0] for r in frame.select(nibud_factor(F.col("y"), F.col("income"))).collect()]
    assert got == [r[2] for r in rows]


def test_reference_csv(spark, tmp_path):
    path = tmp_path / "hra.csv"
    path.write_text("year,max_hra_rate_pct,notes\n2024,36.97,\n2026,37.48,Projected (plan).\n")
    table = reference_tables.read_reference_csv(spark, str(path), "hra_rates")
    years = spark.createDataFrame([(1, 2024), (2, 2026), (3, 2025), (4, None)], "id int, y int")
    found = reference_tables.with_year_value(years, F.col("y"), table, "max_hra_rate_pct", "rate", scale=0.01)
    assert found.columns == ["id", "y", "rate"]
    assert {r["id"]: r["rate"] for r in found.collect()} == {
        1: pytest.approx(0.3697), 2: pytest.approx(0.3748), 3: None, 4: None}
    built_in = reference_tables.reference_table(spark, "nhg_caps")
    assert built_in.count() == 16 and reference_tables.reference_table(spark, "hra_rates").count() == 14
    assert reference_tables.reference_table(spark, "nibud_lti").count() == 12
    caps = spark.createDataFrame([(y,) for y in reference_tables.NHG_CAPS], "y int")
    found = reference_tables.with_year_value(caps, F.col("y"), built_in, "nhg_cap_eur", "cap")
    assert {r["y"]: r["cap"] for r in found.collect()} == reference_tables.NHG_CAPS
    # A table of any length: here 2,000 years, each listed twice.
    long = spark.range(4000).selectExpr("CAST(id % 2000 AS INT) AS year", "CAST(id AS DOUBLE) AS v")
    assert reference_tables.with_year_value(caps, F.col("y") - 2010, long, "v", "v").where("v = y - 10").count() == 16

"""Row operators are stateless and run unchanged on a stream of arriving files."""

from __future__ import annotations

from polderbook.model import TAPE_SCHEMA
from polderbook.operators import anacredit, rules, validation
from tests.rows import REFERENCE_DATE, cases


def test_row_operators_on_a_stream(spark, tmp_path):
    frame = cases(spark, {}, {"current_balance": 400000.0}, {"lgd": 2.0})
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(TAPE_SCHEMA).parquet(str(tmp_path / "in"))
    outputs = {
        "findings": (rules.run_all_rules(stream, REFERENCE_DATE), 1),
        "violations": (validation.schema_violations(stream), 1),
        "attributes": (anacredit.map_tape(stream, on_invalid="skip"), 2),
    }
    for name, (result, rows) in outputs.items():
        query = (
            result.writeStream.format("memory").queryName(name)
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        try:
            assert query.awaitTermination(60)
        finally:
            query.stop()
        assert spark.table(name).count() == rows

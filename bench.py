"""Headline queries, warm, median of three; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from polderbook.plans.queries import queries  # noqa: E402
from polderbook.plans.tape_view import tape_view  # noqa: E402
from polderbook.session import local_session  # noqa: E402

HEADLINE = (
    "quick_scan_kpis", "stage_mix", "energy_label_mix", "vintage_histogram", "derived_fields",
    "schema_valid_flag", "schema_violations", "first_issues", "valid_count",
    "rule_failures", "rule_failures_raw", "rule_counts",
    "anacredit_map", "anacredit_conformance", "counterparty_default",
    "findings_by_severity", "top_findings_severity", "report_header", "cohort_recall",
    "query_by_vintage", "query_by_stage", "nhg_cap_lookup", "nibud_lti",
    "vintage_arrears", "concentration_pc4", "borrower_top", "roll_rate",
    "sicr_triggers", "stress_house_price", "ks_drift", "anomaly_rules", "repayment_mix_anomaly",
    "stage_gate",
)
REPEATS = 3


def _run(frame) -> None:
    # Every row and column is produced, none travels to the driver.
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, **{"spark.ui.showConsoleProgress": "false"})
    start = time.perf_counter()
    rows = tape_view(spark, sf_dir).count()
    prepare = time.perf_counter() - start
    registered = queries()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        _run(registered[name](spark, sf_dir))
        taken = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            _run(registered[name](spark, sf_dir))
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 4)
    total = sum(timings.values())
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(total, 3), "unit": "sec",
        "queries": timings, "sf": sf_dir.rsplit("sf", 1)[-1], "loans": rows,
        "write_tape_sec": round(prepare, 3), "cores": cores, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Bench: headline queries on the tables of $BENCH_SF_DIR with $BENCH_CPUS cores.

Prints one JSON line. Each query runs once to warm up (code generation, file listing) and then
$BENCH_RUNS times; the best time counts. Results are computed in full into Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clauseloom.plans.queries import QUERIES  # noqa: E402
from clauseloom.session import local_session  # noqa: E402

HEADLINE = (
    "rule_verdicts",
    "calendar_verdicts",
    "subsection_verdict",
    "verdict_summary",
    "conformance_report",
    "first_hit",
    "sentences",
    "stated_numbers",
    "quote_search",
    "quote_missing",
    "expression_uses",
    "number_gate",
    "row_receipt_mismatch",
    "graph_integrity",
    "coverage_gaps",
    "test_failures",
    "target_disagreements",
    "readback",
    "blocked_rules",
)


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "clauseloom-bench")
    times = {}
    for name in names:
        run(spark, name, folder)
        times[name] = round(min(run(spark, name, folder) for _ in range(runs)), 3)
    loans = spark.read.parquet(f"{folder}/orders.parquet").count()
    texts = spark.read.parquet(f"{folder}/documents.parquet").count()
    spark.stop()

    def rate(rows: int, name: str):
        return round(rows / times[name]) if name in times else None

    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rates": {
                    "rule verdicts, array form, loans/s": rate(loans, "rule_verdicts"),
                    "rule verdicts, calendar form, loans/s": rate(loans, "calendar_verdicts"),
                    "sentence split, texts/s": rate(texts, "sentences"),
                    "stated numbers, texts/s": rate(texts, "stated_numbers"),
                },
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
                "cores": cores,
            }
        )
    )


if __name__ == "__main__":
    main()

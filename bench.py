"""Benchmark the headline jobs and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_QUERIES=e3_analyze BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py

The test tables are one file with one row group each; a table that is worth a cluster has many. So the tables that the
jobs read are first laid out as 2 files per core in a scratch folder (not timed) and the jobs run on that copy.
Each query is forced end to end with the ``noop`` sink (every row computed, no
collect to the driver): one warm-up run, then the median of ``BENCH_RUNS`` runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "e3_analyze",                   # C1-F4 over all captures, with admission and OCR fold
    "b2_resolve_ocr_budget_5000",   # B1-B3
    "g1_compare_groups",            # G1-G4
    "h1_recent_media",              # H1
    "h2_recent_media_by_turn",      # H2
    "h4_conversation_context",      # H3-H4
    "i2_analyze_incremental",       # I1-I2
    "k1_kind_report",               # K1
    "k2_tag_report",                # K2
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from capsight.plans.queries import QUERIES
    from capsight.session import local_session

    conf = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):  # stage and task times, without the UI
        conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = local_session(cores=cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="capsight-bench", **conf)
    laid_out = tempfile.mkdtemp(prefix="capsight-bench-")
    for name in ("documents", "conversations"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(2 * int(cpus)).write.parquet(f"{laid_out}/{name}.parquet")
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        fn = QUERIES[name]

        def run() -> float:
            t0 = time.perf_counter()
            fn(spark, laid_out).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        run()
        times[name] = round(statistics.median(run() for _ in range(runs)), 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()

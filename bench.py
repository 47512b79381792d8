"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads and
``BENCH_QUERIES`` (optional) a comma list of query names, or ``all`` for the whole catalogue. Each query is warmed up once and
then timed; the value of a query is the median of its runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "snapshot_diff_summary", "snapshot_diff_rows", "as_of_diff", "classify_incoming", "consumer_upsert", "reconcile_apply",
    "risk_flags", "risk_breakdown", "promote_live", "archive_displaced", "held_entries", "settle_holds",
    "restore_versions", "version_list", "last_writer_wins", "ingest_envelopes", "field_catalogue", "dedup_pages",
    "collision_suffix", "facet_counts", "hidden_facets", "tag_equivalence", "hierarchy_levels", "incremental_window",
    "date_histogram", "canonical_hash", "body_term_search", "metadata_field_diff", "body_line_delta",
    "extract_bodies", "next_data", "status_health", "latency_by_type", "cost_rollup", "metric_counts",
    "stream_metric_windows", "stream_dedup", "stream_gate_once",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))

    from tidemark.queries import catalog

    if names == ["all"]:
        names = list(catalog.QUERIES)
    from tidemark.session import build_session

    spark = build_session(
        "bench", f"local[{cpus}]", **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": "16g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        # The noop sink runs the whole plan without moving the result to the driver.
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(repeats)), 4)
    spark.stop()
    print(json.dumps({
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

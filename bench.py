"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8) and prints ONE JSON line. Each result is
materialised with the ``noop`` sink (full execution, nothing collected to the
driver). One warm-up query runs first so JVM start-up is not charged to q1.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from towerlens.plans.catalog import QUERIES  # noqa: E402
from towerlens.session import build_session  # noqa: E402

HEADLINE = [
    "average_by_operator",
    "status_by_postal_code",
    "kpi_operator_join",
    "signal_by_operator_hour",
    "status_by_postal_hour",
    "drop_null_fields",
    "describe_columns",
    "distinct_profile",
    "operator_metrics",
    "operator_metrics_weighted",
    "hourly_metrics",
    "postal_code_status",
    "summary_cards",
    "pivot_status",
    "parse_records",
    "stream_kpi_append",
    "microbatch_kpis",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", app_name="towerlens-bench",
                          shuffle_partitions=max(cpus, 8))
    QUERIES["row_count"](spark, sf_dir).collect()  # warm-up
    n_events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    times: dict[str, float] = {}
    for k in keys:
        t0 = time.perf_counter()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "spark": spark.version,
        "input_rows": n_events,
    }
    if "microbatch_kpis" in times:
        out["microbatch_rows_per_sec"] = round(n_events / times["microbatch_kpis"], 1)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each key of the catalogue on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]``: a warm-up pass over all keys (one run each), then per
headline key the median of three timed runs and per other key one timed run.
A run executes the whole plan into the no-op sink (nothing is collected).
Prints ONE JSON line: {"metric", "value" (sum over the headline keys), "all" (sum over
all keys), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vigilo.plans.catalog import QUERIES  # noqa: E402
from vigilo.session import build_session  # noqa: E402

HEADLINE = [
    "etl_enriched", "kpi1_daily_vitals", "kpi2_hypertension", "kpi3_cardiac_stability",
    "kpi4_oxygenation", "dashboard_view", "table_row_counts", "alerts_batch", "patient_updates",
    "nearest_centre", "alert_summary_patient_day", "alert_stats_by_signal", "monitor_counters",
    "latest_patient_state", "patient_cards", "recent_alerts", "stream_alerts",
]


def run_once(spark, key: str, sf: str) -> float:
    t0 = time.perf_counter()
    QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    keys = sys.argv[1:] or [*HEADLINE, *(k for k in QUERIES if k not in HEADLINE)]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    out, failed = {}, {}
    # warm-up pass over every key first (JVM JIT, codegen caches), then the timed runs
    for k in keys:
        try:
            run_once(spark, k, sf)
        except Exception as e:  # noqa: BLE001 - report the failure, keep measuring the rest
            failed[k] = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
    for k in keys:
        if k in failed:
            continue
        try:
            out[k] = round(statistics.median(run_once(spark, k, sf) for _ in range(reps if k in HEADLINE else 1)), 4)
        except Exception as e:  # noqa: BLE001
            failed[k] = f"{type(e).__name__}: {str(e).splitlines()[0][:200]}"
    m = re.search(r"sf([0-9.]+)", sf)
    result = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(v for k, v in out.items() if k in HEADLINE or sys.argv[1:]), 4),
        "all": round(sum(out.values()), 4),
        "unit": "sec",
        "queries": out,
        "sf": float(m.group(1)) if m else sf,
    }
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

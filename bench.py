"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and
print one JSON line. Each query is executed in full into Spark's no-op sink
(no driver collect). The JVM is warmed up first (untimed) by running every
headline query once on the smallest tables, so timings measure steady-state
execution rather than JIT compilation."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake import bindings  # noqa: E402
from barlake.session import get_session  # noqa: E402

HEADLINE = [
    "hourly_bars",
    "forward_fill",
    "moving_averages",
    "moving_averages_by_user",
    "lead_target",
    "silver_full",
    "silver_incremental",
    "gold_fact",
    "feature_view",
    "quality_metrics",
    "dedupe_keep_last",
    "upsert_merge",
    "star_join",
    "dim_date",
    "constraint_checks",
    "naive_metrics",
    "top_movers",
    "pipeline_silver_incremental",
    "pipeline_gold_features",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    qs = bindings.queries()
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for n in names:
            qs[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.perf_counter()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Headline-query benchmark.

Runs the gold/silver datasets and the heaviest single operators on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``
and prints one JSON line. Each query is fully executed (noop sink, no
collect); the value per query is the median of warm runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hourly_metrics", "orders_enriched", "order_lifecycle", "delivery_performance", "brand_summary",
    "top_brands", "inner_join", "running_total", "event_pivot", "as_of_version", "quality_report",
    "customer_summary_full", "dedup_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    from tessera.plans.catalog import QUERIES
    from tessera.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", app="tessera-bench",
                      **{"spark.sql.shuffle.partitions": str(max(8, int(cpus) * 2))})
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in (os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES")
                         else HEADLINE) if n in QUERIES]
    times: dict[str, float] = {}
    from tessera.plans import pipeline

    # the pipeline run (raw -> bronze -> silver -> gold tables), timed once
    # from scratch; gold queries below read the tables it wrote
    pipeline.reset()
    t = time.perf_counter()
    pipeline.build_all(spark, sf_dir)
    times["pipeline_build"] = round(time.perf_counter() - t, 3)
    for n in names:
        runs = []
        for i in range(reps + 1):
            t = time.perf_counter()
            QUERIES[n].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM and file caches
                runs.append(time.perf_counter() - t)
        times[n] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries.

Runs each query once to warm up, then ``BENCH_RUNS`` times (default 3) into
the ``noop`` sink and records the median. Prints one JSON line:

    {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list to override the headline set).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "daily_region_summary", "inner_join", "multi_join_top_line", "product_performance",
    "cube_region_status", "salted_product_funnel", "dedup_latest", "running_total", "sessionize",
    "market_share", "rfm_segments", "top_k_customers", "collect_products", "flatten_two_level",
    "merge_upsert", "merge_multi_clause", "scd2_merge", "auto_cdc_scd2", "as_of_version", "cdf_propagate",
    "quality_report", "expect_or_drop", "denormalized_facts", "pipeline_medallion",
    "ntile_quartiles", "copy_into_idempotent", "stream_file_ingest", "tumbling_velocity", "zorder_layout",
    "auto_cdc_stream", "stream_merge_upsert", "pipeline_retail", "pipeline_payments", "pipeline_layout",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE

    from tidepool.plans import registry_dicts
    from tidepool.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                      extra={"spark.driver.memory": "16g"})
    fns, _ = registry_dicts()
    timings: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        fn = fns[name]

        def once() -> float:
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        try:
            once()  # warm-up
            timings[name] = round(statistics.median(once() for _ in range(runs)), 3)
            print(f"# {name}: {timings[name]}s", file=sys.stderr)
        except Exception as e:  # keep measuring the others; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            print(f"# {name}: FAILED {errors[name]}", file=sys.stderr)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

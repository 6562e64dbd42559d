"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Protocol: one warm session; each query is planned and forced with a ``noop`` write; one warm-up
pass over all queries, then the best of ``$BENCH_REPEAT`` (default 3) timed passes per query.
The pipeline query times the full raw-CSV -> cleaned -> checked -> published run (the raw files
are exported once, before timing).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopmarts.plans import mapping, marts, pipeline  # noqa: E402
from shopmarts.session import build_session, scratch_path  # noqa: E402

MARTS = {
    "m01_monthly_revenue": marts.mart_monthly_revenue,
    "m02_top_categories": marts.mart_top_categories,
    "m03_delivery_by_state": marts.mart_delivery_by_state,
    "m04_cohort_retention": marts.mart_cohort_retention,
    "m05_rfm_segments": marts.mart_rfm_segments,
    "m06_seller_ranking": marts.mart_seller_ranking,
    "m07_payment_mix": marts.mart_payment_mix,
    "m08_installment_buckets": marts.mart_installment_buckets,
    "m09_delay_vs_reviews": marts.mart_delay_vs_reviews,
    "m10_repeat_rate": marts.mart_repeat_rate,
    "m11_order_histogram": marts.mart_order_histogram,
    "m12_freight_by_region": marts.mart_freight_by_region,
}


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # spark.checkpoint.dir from the session when set; a folder of our own only on an unset local master
    scratch = scratch_path(spark, "bench")
    raw_dir = f"{scratch}/raw"
    mapping.export_raw_files(spark, sf_dir, raw_dir)

    def run_mart(fn):
        _force(fn(mapping.model_tables(spark, sf_dir)))

    runs = 0

    def run_pipeline():
        nonlocal runs
        runs += 1
        pipeline.run_pipeline(spark, raw_dir, f"{scratch}/warehouse{runs}")

    jobs = {name: (lambda fn=fn: run_mart(fn)) for name, fn in MARTS.items()}
    jobs["pipeline_csv_to_warehouse"] = run_pipeline

    for job in jobs.values():  # warm-up
        job()
    best = {}
    for name, job in jobs.items():
        times = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            job()
            times.append(time.perf_counter() - t0)
        best[name] = round(min(times), 3)
    total = round(sum(best.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_best_query_seconds", "value": total, "unit": "sec",
                      "queries": best, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()

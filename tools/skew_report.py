"""Measure task skew from Spark's event log: a third of all orders on one person / one seller.

Usage: python tools/skew_report.py [sf_dir] [eventlog_dir]
For each mart and the key/reference gate (one order with a third of all items), prints the largest share of a stage's shuffle-read records handled by one task
(over stages that read at least 10,000 records). 1/partitions is perfect; ~0.33 would mean the
hot key landed in one task.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shopmarts.operators import quality  # noqa: E402
from shopmarts.plans import mapping, marts  # noqa: E402
from shopmarts.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="shopmarts-eventlog-")
    os.makedirs(log_dir, exist_ok=True)
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
                                                 "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    t = mapping.model_tables(spark, sf_dir)
    t["customers"] = t["customers"].withColumn(
        "customer_unique_id", F.when(F.col("customer_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_unique_id")))
    t["order_items"] = t["order_items"].withColumn(
        "seller_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("seller_id")))
    groups = {}
    for name in ("mart_cohort_retention", "mart_rfm_segments", "mart_repeat_rate", "mart_seller_ranking",
                 "mart_freight_by_region"):
        spark.sparkContext.setJobGroup(name, name)
        getattr(marts, name)(t).write.format("noop").mode("overwrite").save()
        groups[name] = name
    # key gate: on top of the hot seller, one order holds a third of all items
    hot_order = t["orders"].agg(F.min("order_id")).first()[0]
    t["order_items"] = t["order_items"].withColumn(
        "order_id", F.when(F.col("order_id") % 3 == 1, F.lit(hot_order)).otherwise(F.col("order_id")))
    spark.sparkContext.setJobGroup("quality_key_gate", "quality_key_gate")
    quality.quality_report(dict(t), with_column_checks=False).collect()
    app = spark.sparkContext.applicationId
    spark.stop()
    path = [p for p in glob.glob(f"{log_dir}/*") if app in p][0]
    files = sorted(glob.glob(f"{path}/events_*")) if os.path.isdir(path) else [path]
    lines = (line for f in files for line in open(f))
    stage_group, per_stage = {}, {}
    job_group = {}
    for line in lines:
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(recs)
    worst = {}
    for sid, recs in per_stage.items():
        total = sum(recs)
        g = stage_group.get(sid)
        if total >= 10000 and g:
            share = max(recs) / total
            worst[g] = max(worst.get(g, 0.0), share)
    for g, share in worst.items():
        print(f"{g:28s} largest one-task share of a stage's shuffle records: {share:.3f}")


if __name__ == "__main__":
    main()

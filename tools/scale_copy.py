"""Write a k-times copy of a driver-table folder (keys offset per replica) for scale probes.

Usage: python tools/scale_copy.py SRC_DIR DST_DIR K
Each replica r shifts every key by r * (max key + 1), so joins stay within a replica and the
distributions the mapping views rely on (key modulo rules) are preserved. Rows are multiplied with
``explode(sequence(0, K-1))``; nation and region are copied as they are.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shopmarts.session import build_session  # noqa: E402

KEYS = {
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders", "l_partkey": "part", "l_suppkey": "supplier"},
    "customer": {"c_custkey": "customer"},
    "part": {"p_partkey": "part"},
    "supplier": {"s_suppkey": "supplier"},
}
OWN = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def main():
    src, dst, k = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = build_session("local[8]", 16)
    span = {t: spark.read.parquet(f"{src}/{t}.parquet").agg(F.max(c)).first()[0] + 1 for t, c in OWN.items()}
    for t in ("nation", "region"):
        spark.read.parquet(f"{src}/{t}.parquet").write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    for t, cols in KEYS.items():
        df = spark.read.parquet(f"{src}/{t}.parquet").withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        df = df.withColumns({c: F.col(c) + F.col("_r") * F.lit(span[owner]) for c, owner in cols.items()}).drop("_r")
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()

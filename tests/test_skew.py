"""A third of all orders belong to one person (and a hot seller): marts must stay exact."""
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from shopmarts.plans import mapping, marts, oracle
from tests.conftest import SF_SMALL
from tools.check_oracles import TABLES, rows_key

HOT_PERSON = "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END"
HOT_SELLER = f"CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE {oracle.SELLER_OF_ITEM} END"


@pytest.fixture(scope="module")
def skewed(spark):
    t = mapping.model_tables(spark, SF_SMALL)
    c = t["customers"]
    t["customers"] = c.withColumn(
        "customer_unique_id", F.when(F.col("customer_id") % 3 == 0, F.lit(-1)).otherwise(F.col("customer_unique_id")))
    i = t["order_items"]
    t["order_items"] = i.withColumn("seller_id", F.when(F.col("order_id") % 3 == 0, F.lit(1)).otherwise(F.col("seller_id")))
    return t


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _skew_sql(sql: str) -> str:
    sql = sql.replace("o_custkey AS customer_unique_id", f"{HOT_PERSON} AS customer_unique_id")
    return sql.replace(f"{oracle.SELLER_OF_ITEM} AS seller_id", f"{HOT_SELLER} AS seller_id")


@pytest.mark.parametrize("name, sql", [
    ("mart_cohort_retention", oracle.MART_COHORT_RETENTION),
    ("mart_rfm_segments", oracle.MART_RFM_SEGMENTS),
    ("mart_repeat_rate", oracle.MART_REPEAT_RATE),
    ("mart_order_histogram", oracle.MART_ORDER_HISTOGRAM),
    ("mart_seller_ranking", oracle.MART_SELLER_RANKING),
    ("mart_freight_by_region", oracle.MART_FREIGHT_BY_REGION),
])
def test_hot_keys_exact(spark, con, skewed, name, sql):
    df = getattr(marts, name)(skewed)
    res = con.execute(_skew_sql(sql))
    cols = [d[0] for d in res.description]
    assert rows_key([tuple(r) for r in df.collect()], df.columns) == rows_key(res.fetchall(), cols)


def test_hot_person_really_is_hot(skewed):
    top = marts.orders_per_person(skewed).orderBy(F.col("order_count").desc()).first()
    assert top.customer_unique_id == -1 and top.order_count >= 400

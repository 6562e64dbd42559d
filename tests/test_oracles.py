"""Every queries() key against its oracle SQL (DuckDB) on the smallest driver tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from shopmarts.plans.catalog import QUERIES
from tests.conftest import SF_SMALL
from tools.check_oracles import TABLES, rows_key, type_diffs

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "order_month"


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql()[key]  # every core key has one
    rel = con.sql(sql)
    assert type_diffs(df, rel.columns, rel.types) == {}
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_key(rows, df.columns) == rows_key(res.fetchall(), cols)

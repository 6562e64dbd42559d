import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shopmarts.operators import ranking


def _frame(spark, n, ties):
    rnd = random.Random(n)
    rows = [(i, 1 if rnd.random() < ties else rnd.randint(0, 50)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long")


@pytest.mark.parametrize("n", [0, 1, 4, 5, 7, 59, 503])
@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_global_ntile_equals_window(spark, n, ranges):
    df = _frame(spark, n, 0.97)
    got = ranking.global_ntile(df, 5, ["k", "id"], "t", ranges=ranges)
    want = df.withColumn("t", F.ntile(5).over(Window.orderBy("k", "id")))
    assert sorted(map(tuple, got.select("id", "t").collect())) == sorted(map(tuple, want.select("id", "t").collect()))


def test_ranges_that_hold_a_cut_follow_the_shuffle_partitions(spark):
    df = _frame(spark, 6000, 0.5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        cuts = ranking.tile_cuts(df, 5, ["k", "id"], ranges=8)
        got = spark.range(1).select(cuts.alias("c")).first().c
        held, last = ranking._cut_ranges(df, 5, ["k", "id"], 8)
        largest = max(r["count"] for r in held.groupBy("range").count().collect())
        assert last.count() == 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(map(tuple, df.select("k", "id").collect()))
    assert sorted(map(tuple, got)) == [rows[i * 1200 - 1] for i in range(1, 5)]
    assert largest < 6000 / 20


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = _frame(spark, 1003, 0.97)
    sizes = [r[1] for r in ranking.global_ntile(df, 5, ["k", "id"], "t", ranges=6).groupBy("t").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 1003


@pytest.mark.parametrize("desc", [True, False])
def test_global_dense_rank_equals_window(spark, desc):
    rows = [(i, None if i % 17 == 0 else (i * 7) % 23) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, v long")
    got = ranking.global_dense_rank(df, "v", "r", descending=desc, ranges=4)
    order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(order)))
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))


def test_top_dense_rank_matches_full_rank(spark):
    rows = [(i, (i * 13) % 9) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v long")
    top = ranking.top_dense_rank(df, "v", "id", 20, "r")
    full = (df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc())))
            .orderBy(F.col("v").desc(), "id").limit(20))
    assert sorted(map(tuple, top.select("id", "r").collect())) == sorted(map(tuple, full.select("id", "r").collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_a_range_is_sorted_for_its_cut(spark):
    """Windows over rows are by range; what meets in one partition are samples and one row per range."""
    df = _frame(spark, 2000, 0.5)
    cuts = ranking.tile_cuts(df, 5, ["k", "id"], ranges=8)
    plan = spark.range(1).select(cuts)._jdf.queryExecution().optimizedPlan().toString()
    numbered = [line for line in plan.splitlines() if "row_number()" in line]
    assert numbered and all("windowspecdefinition(range" in line for line in numbered)
    plain = df.withColumn("t", F.ntile(5).over(Window.orderBy("k", "id")))
    plain.collect()
    assert "SinglePartition" in _plan(plain)


@pytest.mark.parametrize("n", [0, 3, 97, 600])
def test_global_ntiles_shared_passes(spark, n):
    rnd = random.Random(n)
    rows = [(i, rnd.choice([1, 1, 1, 2]), rnd.randint(0, 1000) / 7.0) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, f long, m double")
    got = ranking.global_ntiles(df, 5, {"a": ["f", "id"], "b": ["m", "id"]}, ranges=5)
    want = (df.withColumn("a", F.ntile(5).over(Window.orderBy("f", "id")))
            .withColumn("b", F.ntile(5).over(Window.orderBy("m", "id"))))
    cols = ["id", "a", "b"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_ntile_orders_nulls_first(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i % 7) for i in range(211)], "id long, k long")
    got = ranking.global_ntile(df, 4, ["k", "id"], "t", ranges=6)
    want = df.withColumn("t", F.ntile(4).over(Window.orderBy("k", "id")))
    assert sorted(map(tuple, got.select("id", "t").collect())) == sorted(map(tuple, want.select("id", "t").collect()))


def test_several_ntiles_join_nothing_on_the_row_id(spark):
    df = _frame(spark, 2000, 0.5)
    out = ranking.global_ntiles(df, 5, {"a": ["k", "id"], "b": ["id"]}, ranges=8)
    main = out._jdf.queryExecution().optimizedPlan().toString().split("scalar-subquery")[0]
    assert "Join" not in main and "Sort" not in main and "Window" not in main


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz", "date", "double", "long"])
@pytest.mark.parametrize("desc", [True, False])
def test_dense_rank_of_any_ordered_type(spark, kind, desc):
    least = -(2**63)
    df = spark.range(90).select("id", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 8).alias("n"))
    value = {"string": F.concat(F.lit("v"), F.col("n").cast("string")), "long": F.when(F.col("n") == 0, F.lit(least)).otherwise(F.col("n")),
             "double": F.col("n") / 3, "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")),
             "timestamp_ntz": F.date_add(F.lit("2020-01-01").cast("date"), F.col("n").cast("int")).cast("timestamp_ntz")}[kind]
    df = df.select("id", value.alias("v"))
    got = ranking.global_dense_rank(df, "v", "r", descending=desc, ranges=3)
    order = F.col("v").desc_nulls_last() if desc else F.col("v").asc_nulls_first()
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(order)))
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, want.select("id", "r").collect()))


def test_dense_rank_of_a_value_that_most_rows_share(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).alias("v"))
    got = {r.v: r.r for r in ranking.global_dense_rank(df, "v", "r", ranges=4).select("v", "r").distinct().collect()}
    want = {v: k for k, v in enumerate(sorted(got, reverse=True), 1)}
    assert got == want and got[5] == 3000


def test_cut_lineage_keeps_a_cache_of_the_caller(spark):
    from shopmarts.session import cut_lineage

    df = spark.range(50).cache()
    cut_lineage(df)
    assert df.is_cached
    df.unpersist()


def test_cut_lineage_releases_its_cache(spark):
    from shopmarts.session import cut_lineage

    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    out = cut_lineage(df)
    assert not df.is_cached  # the cache only bridges the two checkpoint jobs
    assert out.agg(F.sum("x")).first()[0] == sum(2 * i for i in range(1000))


@pytest.mark.parametrize("descending", [True, False])
def test_dense_rank_of_heavy_values_meets_no_join(spark, descending):
    """Half of all rows on one value, a fifth on NULL: both are ranked where they lie."""
    df = spark.range(5000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 7 WHEN id % 10 < 4 THEN NULL ELSE CAST(id % 997 AS INT) END AS v")
    got = ranking.global_dense_rank(df, "v", "r", descending=descending, ranges=6)
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
    want = df.withColumn("r", F.dense_rank().over(Window.orderBy(order)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

    def names(plan):  # without the plans of scalar subqueries, which read one row a value
        below = plan.children()
        return [plan.nodeName()] + [n for i in range(below.size()) for n in names(below.apply(i))]

    heavy, others = (names(got._jdf.queryExecution().optimizedPlan().children().apply(i)) for i in (0, 1))
    assert not {"Join", "Aggregate", "Sort", "Repartition"} & set(heavy) and others.count("Join") >= 1


def test_dense_rank_without_rows(spark):
    assert ranking.global_dense_rank(spark.range(0), "id", "r").collect() == []


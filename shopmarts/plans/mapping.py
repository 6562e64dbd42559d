"""Driver test tables -> the nine-table order model (the mapping views of FIXTURES.md §4).

Every view is a lazy DataFrame over the parquet files, so projections and filters of a mart reach
the scan. ``model_tables`` gives the cleaned model; ``raw_frames`` gives the same data shaped as
the nine raw CSV files (all text, messy casing and padding, duplicates), which is what the source,
cleaning and pipeline operators consume.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopmarts.session import freed_shuffles
from shopmarts.sources.contracts import BY_TABLE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


_SCANS: dict[tuple[str, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one driver table; the resolved scan is reused within a Spark application
    (schema inference reads footers on the driver, so re-resolving it per query costs ~0.1 s)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def _days(n) -> F.Column:
    return F.make_dt_interval(days=n.cast("int"))


# --------------------------------------------------------------------------- model views
# The views are SQL expression lists (``selectExpr``): one JVM call per view instead of one per
# column function, which is most of a small query's planning time on a slow driver.
def _plus_days(ts: str, days: str) -> str:
    return f"{ts} + make_dt_interval(CAST({days} AS INT))"


def m_orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_orderkey AS order_id",
        "o_orderkey AS customer_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'O' THEN 'shipped'"
        " ELSE 'processing' END AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        "CASE WHEN o_orderstatus = 'F' AND o_orderkey % 29 <> 0"
        f" THEN {_plus_days('o_orderdate', 'o_orderkey * 37 % 40')} END AS order_delivered_customer_date",
        f"CASE WHEN o_orderkey % 31 <> 0 THEN {_plus_days('o_orderdate', '15 + o_orderkey * 13 % 15')} END"
        " AS order_estimated_delivery_date",
    )


def m_customers(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").selectExpr("o_orderkey AS customer_id", "o_custkey AS customer_unique_id")
    c = read_table(spark, sf_dir, "customer").selectExpr("c_custkey AS customer_unique_id",
                                                         "c_nationkey AS customer_zip_code_prefix")
    n = read_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS customer_zip_code_prefix",
                                                       "n_name AS customer_state")
    return (o.join(c, "customer_unique_id").join(n, "customer_zip_code_prefix")
            .select("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_state"))


def m_sellers(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS seller_id", "s_nationkey AS seller_zip_code_prefix")
    n = read_table(spark, sf_dir, "nation").selectExpr("n_nationkey AS seller_zip_code_prefix", "n_name AS seller_state")
    return s.join(n, "seller_zip_code_prefix").select("seller_id", "seller_zip_code_prefix", "seller_state")


_CATEGORY = "p_type || ' ' || CAST(p_partkey % 4 AS STRING)"  # more categories than a top list shows


def m_products(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.selectExpr("p_partkey AS product_id",
                        f"CASE WHEN p_partkey % 17 <> 0 THEN {_CATEGORY} END AS product_category_name")


def m_translation(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part").where("p_type <> 'PROMO'")
    return p.selectExpr(f"{_CATEGORY} AS product_category_name", f"lower({_CATEGORY}) AS product_category_name_english").distinct()


# Sellers 7, 32, ... keep few of their orders and sellers 9, 34, ... only orders without a review; the
# other items go to the seller before. Sellers 3, 13, ... give everything away: their revenue ties at 0.
_SELLER = ("CASE WHEN l_suppkey % 25 = 7 AND l_orderkey % 211 <> 0 THEN l_suppkey - 1"
           " WHEN l_suppkey % 25 = 9 AND l_orderkey % 11 <> 0 THEN l_suppkey - 1 ELSE l_suppkey END")
_PRICE = "CASE WHEN l_suppkey % 10 = 3 OR l_orderkey % 41 = 0 THEN 0 ELSE l_extendedprice END"


def m_items(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_orderkey AS order_id", "l_linenumber AS order_item_id", "l_partkey AS product_id",
        f"{_SELLER} AS seller_id", "l_shipdate AS shipping_limit_date",
        f"CAST({_PRICE} AS DECIMAL(12,2)) AS price",
        "CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value",
    )


def m_payments(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_orderkey AS order_id", "1 AS payment_sequential",
        "CASE WHEN o_orderkey % 4 < 2 THEN 'credit_card' WHEN o_orderkey % 4 = 2 THEN 'boleto'"
        " ELSE 'voucher' END AS payment_type",
        "CAST(o_orderkey * 7 % 15 AS INT) AS payment_installments",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value",
    )


def m_reviews(spark, sf_dir) -> DataFrame:
    """One review for most orders, a second one with another score for every fifth order."""
    o = read_table(spark, sf_dir, "orders").where("o_orderkey % 11 <> 0")
    return o.selectExpr("o_orderkey", "explode(IF(o_orderkey % 5 = 0, array(0, 1), array(0))) AS nth").selectExpr(
        "o_orderkey * 2 + nth AS review_id", "o_orderkey AS order_id",
        "CAST(1 + (o_orderkey * 3 + nth * (1 + o_orderkey div 5)) % 5 AS INT) AS review_score")


def m_raw_reviews(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "l_orderkey * 10 + l_linenumber AS review_id", "l_orderkey AS order_id",
        "CAST(1 + l_partkey % 5 AS INT) AS review_score",
        "CASE WHEN l_partkey % 23 <> 0 THEN l_shipdate END AS review_answer_timestamp",
    )


def m_raw_geo(spark, sf_dir) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.selectExpr("c_nationkey AS zip", "c_custkey AS ord", "CAST(c_acctbal AS DECIMAL(12,2)) AS lat",
                        "c_mktsegment AS city")


class _LazyTables(dict):
    """Table name -> DataFrame, each view planned on first use (a mart touches only what it needs)."""

    def __init__(self, factories):
        super().__init__()
        self._factories = factories

    def __missing__(self, name):
        df = self._factories[name]()
        self[name] = df
        return df

    def __contains__(self, name):
        return name in self._factories

    def keys(self):
        return self._factories.keys()

    def __iter__(self):
        return iter(self._factories)

    def items(self):
        return [(k, self[k]) for k in self._factories]


def model_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine-table model minus geolocation (no counterpart in the driver tables)."""
    return _LazyTables({
        "orders": lambda: m_orders(spark, sf_dir),
        "customers": lambda: m_customers(spark, sf_dir),
        "sellers": lambda: m_sellers(spark, sf_dir),
        "products": lambda: m_products(spark, sf_dir),
        "product_category_translation": lambda: m_translation(spark, sf_dir),
        "order_items": lambda: m_items(spark, sf_dir),
        "order_payments": lambda: m_payments(spark, sf_dir),
        "order_reviews": lambda: m_reviews(spark, sf_dir),
    })


# --------------------------------------------------------------------------- raw files
GZIP_RECORDS = 250_000


def _state_code(nationkey) -> F.Column:
    """Two-letter state code per nation: 'N' + a letter (25 nations -> NA..NY)."""
    return F.concat(F.lit("N"), F.chr(F.lit(65) + nationkey))


def _messy(text, key) -> F.Column:
    """Deterministic padding/casing noise the cleaning step must undo."""
    m = key % 4
    return (F.when(m == 0, F.concat(F.lit("\t "), text, F.lit(" \n")))
            .when(m == 1, F.concat(F.lit(" "), F.lower(text)))
            .when(m == 2, F.concat(F.lower(text), F.lit("  ")))
            .otherwise(text))


def _ts_text(ts) -> F.Column:
    return F.col(ts).cast("string") if isinstance(ts, str) else ts.cast("string")


def raw_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The nine raw CSV files (target table -> all-text DataFrame) derived from the driver tables."""
    orders = read_table(spark, sf_dir, "orders")
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = read_table(spark, sf_dir, "supplier")
    part = read_table(spark, sf_dir, "part")
    lineitem = read_table(spark, sf_dir, "lineitem")
    mo = m_orders(spark, sf_dir)
    s = lambda c: F.col(c).cast("string")

    cust = (orders.select("o_orderkey", "o_custkey")
            .join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")))
    customers = cust.select(
        s("o_orderkey").alias("customer_id"), s("o_custkey").alias("customer_unique_id"),
        s("c_nationkey").alias("customer_zip_code_prefix"),
        _messy(F.col("c_mktsegment"), F.col("o_orderkey")).alias("customer_city"),
        _messy(_state_code(F.col("c_nationkey")), F.col("o_orderkey") + 1).alias("customer_state"))

    geolocation = customer.select(
        s("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 100).cast("decimal(12,6)").cast("string").alias("geolocation_lat"),
        (F.col("c_acctbal") / -50).cast("decimal(12,6)").cast("string").alias("geolocation_lng"),
        F.when(F.col("c_custkey") % 5 != 0, _messy(F.col("c_mktsegment"), F.col("c_custkey"))).alias("geolocation_city"),
        F.when(F.col("c_custkey") % 7 != 0, _messy(_state_code(F.col("c_nationkey")), F.col("c_custkey"))).alias("geolocation_state"),
        F.col("c_custkey").alias("_file_order"))

    k = F.col("order_id")
    raw_orders = mo.select(
        s("order_id"), s("customer_id"),
        F.when(F.col("order_status") == "delivered", " Delivered")
        .when(F.col("order_status") == "shipped", "SHIPPED ").otherwise("processing").alias("order_status"),
        _ts_text("order_purchase_timestamp").alias("order_purchase_timestamp"),
        F.when(k % 13 == 0, F.lit("not a date")).when(k % 11 == 0, F.lit(None))
        .otherwise(_ts_text(F.col("order_purchase_timestamp") + _days(k % 3))).alias("order_approved_at"),
        F.lit(None).cast("string").alias("order_delivered_carrier_date"),
        _ts_text("order_delivered_customer_date").alias("order_delivered_customer_date"),
        _ts_text("order_estimated_delivery_date").alias("order_estimated_delivery_date"))

    # numbered before any text is made: a window's own selection would shuffle the texts with the numbers
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    item_no = F.row_number().over(Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax"))
    numbered = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_tax").withColumn("item_no", item_no)
    items = numbered.select(
        s("l_orderkey").alias("order_id"), s("item_no").alias("order_item_id"),
        s("l_partkey").alias("product_id"), s("l_suppkey").alias("seller_id"),
        _ts_text("l_shipdate").alias("shipping_limit_date"), price.cast("string").alias("price"),
        F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2).cast("string").alias("freight_value"))

    ok = F.col("o_orderkey")
    payments = orders.select(
        s("o_orderkey").alias("order_id"), F.lit("1").alias("payment_sequential"),
        F.when(ok % 4 < 2, " Credit_Card").when(ok % 4 == 2, "BOLETO ").otherwise("voucher").alias("payment_type"),
        (ok * 7 % 15).cast("string").alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("payment_value"))

    lk, pk = F.col("l_orderkey"), F.col("l_partkey")
    reviews = lineitem.select(
        (lk * 10 + F.col("l_linenumber")).cast("string").alias("review_id"), s("l_orderkey").alias("order_id"),
        (1 + pk % 5).cast("string").alias("review_score"),
        F.when(pk % 3 == 0, F.lit("NA")).otherwise(F.concat(F.lit("item "), s("l_linenumber"))).alias("review_comment_title"),
        F.when(pk % 2 == 0, F.concat(F.lit('said "ok"'), F.lit("\n"), F.lit("second line, with comma")))
        .alias("review_comment_message"),
        _ts_text("l_shipdate").alias("review_creation_date"),
        F.when(pk % 23 != 0, _ts_text(F.col("l_shipdate") + _days(pk % 5))).alias("review_answer_timestamp"))

    products = part.select(
        s("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 17 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        (F.col("p_size") * 7).cast("string").alias("product_description_lenght"),
        (F.col("p_size") % 5).cast("string").alias("product_photos_qty"),
        (F.col("p_retailprice") * 10).cast("string").alias("product_weight_g"),
        s("p_size").alias("product_length_cm"), (F.col("p_size") % 7 + 1).cast("string").alias("product_height_cm"),
        (F.col("p_size") % 11 + 2).cast("string").alias("product_width_cm"))

    sup = supplier.select("s_suppkey", "s_nationkey", "s_name")
    sellers = sup.select(
        s("s_suppkey").alias("seller_id"), s("s_nationkey").alias("seller_zip_code_prefix"),
        _messy(F.col("s_name"), F.col("s_suppkey")).alias("seller_city"),
        _messy(_state_code(F.col("s_nationkey")), F.col("s_suppkey")).alias("seller_state"))

    translation = part.where(F.col("p_type") != "PROMO").select(
        F.col("p_type").alias("product_category_name"),
        F.concat(F.lower("p_type"), F.lit("_"), s("p_partkey")).alias("product_category_name_english"),
        F.col("p_partkey").alias("_file_order"))

    return {
        "customers": customers,
        "geolocation": geolocation,
        "orders": raw_orders,
        "order_items": items,
        "order_payments": payments,
        "order_reviews": reviews,
        "products": products,
        "sellers": sellers,
        "product_category_translation": translation,
    }


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", gzipped: bool = False) -> None:
    """RFC 4180 CSV with a header: doubled quotes, quoted newlines, NULL as an empty field. A ``gzipped`` file cannot be
    read in ranges, so it holds ``GZIP_RECORDS`` at most."""
    writer = df.write.mode(mode).option("header", True).option("escape", '"').option("quote", '"')
    if gzipped:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", GZIP_RECORDS)
    writer.csv(path)


def write_lines(df: DataFrame, header: str, path: str) -> None:
    """Finished CSV lines (``value``) with a header on top of every file, for lines that a CSV writer would not make.
    Each partition is a file; one more holds the header only, so that lines of no partition have a file too."""

    def headed(batches):
        yield pa.RecordBatch.from_arrays([pa.array([header], pa.string())], names=["value"])
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["value"])

    empty = df.sparkSession.range(0, 1, 1, 1).where("id < 0").select(F.lit("").alias("value"))
    df.select("value").unionByName(empty).mapInArrow(headed, "value string").write.text(path)


def write_raw(df: DataFrame, path: str) -> None:
    """One raw file; with ``_file_order`` its records are in that order across ordered part files."""
    if "_file_order" in df.columns:
        df = df.repartitionByRange(4, "_file_order").sortWithinPartitions("_file_order").drop("_file_order")
    write_csv(df, path)


def export_raw_files(spark: SparkSession, sf_dir: str, raw_dir: str, prefix: str = "", without=(), gzipped=()) -> dict[str, str]:
    """Write the nine raw files (one CSV folder each) derived from the driver tables; those of the tables
    ``without`` have a header only, those ``gzipped`` (none with a defined order) are compressed.

    Files with a defined order (translation, geolocation) are written so that "first in file order" is
    well defined for the keep-first and collapse steps. The writes are independent jobs and run side by side.
    """
    paths = {table: f"{raw_dir.rstrip('/')}/{BY_TABLE[table].file_name(prefix)}" for table in BY_TABLE}

    def export(item):
        table, df = item
        if table in without:
            write_lines(df.where("false").select(F.lit("").alias("value")), ",".join(BY_TABLE[table].columns), paths[table])
        elif table in gzipped:
            write_csv(df, paths[table], gzipped=True)
        else:
            write_raw(df, paths[table])
        return table

    frames = raw_frames(spark, sf_dir)
    with freed_shuffles(spark), ThreadPoolExecutor(max_workers=len(BY_TABLE)) as pool:
        return {table: paths[table] for table in pool.map(inheritable_thread_target(spark)(export), frames.items())}

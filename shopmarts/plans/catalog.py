"""Registry of query keys: name -> callable(spark, sf_dir) -> DataFrame.

Every key reads the driver tables (through ``mapping``) so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmarts.functions.exprs import (
    avg_exact, clean_code, clean_text, days_between, dec_div, dec_ratio, month_floor, month_label, month_offset,
    na_to_null, publish, rounded, share_true, to_datetime,
)
from shopmarts.operators import clean, quality, ranking
from shopmarts.plans import mapping, marts, pipeline
from shopmarts.session import cut_lineage, remove_path, scratch_path
from shopmarts.sources import csv_source, parquet_sink
from shopmarts.sources.contracts import BY_TABLE

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return mapping.model_tables(spark, sf_dir)


def _mart(fn, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_t(spark, sf_dir), **params)

    run.__name__ = fn.__name__
    return run


def q_win_ntile(spark, sf_dir):
    people = marts.person_totals(_t(spark, sf_dir))
    people = cut_lineage(people.select("customer_unique_id", "frequency"))
    out = ranking.global_ntile(people, 5, ["frequency", "customer_unique_id"], "f_score")
    return out.select("customer_unique_id", F.col("frequency").cast("long"), "f_score")


def q_rfm_scores(spark, sf_dir):
    """W3 three times: every person's recency days and recency, frequency and money scores."""
    scored = marts.rfm_scores(_t(spark, sf_dir))
    return scored.select("customer_unique_id", "recency_days", F.col("frequency").cast("long"),
                         publish("monetary").alias("monetary"), "r_score", "f_score", "m_score")


def q_win_dense_rank_hot(spark, sf_dir):
    """W4 over every order's item count: few values, each shared by a large part of the rows."""
    per_order = cut_lineage(marts.items_per_order(_t(spark, sf_dir)).select("order_id", F.col("n_items").cast("long")))
    ranked = ranking.global_dense_rank(per_order, "n_items", "size_rank", descending=True)
    return ranked.select("order_id", "n_items", F.col("size_rank").cast("long"))


def q_join_fanout_average(spark, sf_dir):
    """Item-weighted review average per seller over all statuses (the M6 CTE on its own)."""
    st = marts.seller_stats(_t(spark, sf_dir)).where(F.col("w_count") > 0)
    return st.select("seller_id", rounded(dec_div("w_score", "w_count", 4), 2).alias("avg_review_score"))


def q_case_bucket(spark, sf_dir):
    o = marts.delivered_orders(_t(spark, sf_dir)).where(F.col("order_delivered_customer_date").isNotNull())
    d = days_between("order_delivered_customer_date", "order_estimated_delivery_date")
    return o.select("order_id", d.alias("delay_days"), marts.delay_bucket(d).alias("delivery_bucket"))


# --------------------------------------------------------------------------- raw files in memory
def _raw_typed(spark, sf_dir, table: str, na: bool = True) -> DataFrame:
    """Raw text frame -> NA tokens as NULL -> typed by name, the same steps the CSV path takes."""

    raw = mapping.raw_frames(spark, sf_dir)[table]
    if na:
        raw = raw.select(*[na_to_null(c).alias(c) if c != "_file_order" else F.col(c) for c in raw.columns])
    return csv_source.conform(raw, BY_TABLE[table])


def _money_as_double(df: DataFrame) -> DataFrame:

    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def _transform(table: str):
    def run(spark, sf_dir):
        out = clean.TRANSFORMS[table](_raw_typed(spark, sf_dir, table))
        return _money_as_double(out.select(*BY_TABLE[table].schema.fieldNames()))

    run.__name__ = f"t_{table}"
    return run


def q_clean_text(spark, sf_dir):
    raw = mapping.raw_frames(spark, sf_dir)["customers"]
    return raw.select("customer_id", clean_text("customer_city").alias("customer_city"))


def q_clean_state(spark, sf_dir):
    raw = _raw_typed(spark, sf_dir, "customers")
    return raw.select("customer_id", clean_code("customer_state").alias("customer_state"))


def q_clean_to_datetime(spark, sf_dir):
    raw = mapping.raw_frames(spark, sf_dir)["orders"]
    return raw.select("order_id", to_datetime("order_approved_at").alias("order_approved_at"))


def q_clean_rename(spark, sf_dir):
    out = clean.transform_products(_raw_typed(spark, sf_dir, "products"))
    return out.select("product_id", "product_name_length", "product_description_length")


def q_dedup_full_row(spark, sf_dir):
    return clean.drop_identical(mapping.m_raw_reviews(spark, sf_dir))


def q_dedup_keep_latest(spark, sf_dir):
    return clean.keep_latest(mapping.m_raw_reviews(spark, sf_dir), ["review_id", "order_id"], "review_answer_timestamp")


def q_dedup_keep_first(spark, sf_dir):
    tr = mapping.raw_frames(spark, sf_dir)["product_category_translation"]
    return clean.keep_first(tr, ["product_category_name"], order_col="_file_order")


def q_geo_collapse(spark, sf_dir):
    g = clean.collapse_by_key(mapping.m_raw_geo(spark, sf_dir), "zip", means=("lat",), firsts=("city",), order_col="ord")
    return g.select("zip", "lat", "city")


# --------------------------------------------------------------------------- CSV round trips
def _exported(spark, sf_dir, table: str, columns=None) -> tuple[str, object]:
    """Write one raw file as CSV below the shared scratch folder; returns (raw_dir, contract)."""

    c = BY_TABLE[table]
    raw_dir = scratch_path(spark, f"raw-{table}")
    df = mapping.raw_frames(spark, sf_dir)[table]
    mapping.write_csv(df.select(*(columns or c.columns)), f"{raw_dir}/{c.file_name()}")
    return raw_dir, c


def q_src_csv_scan(spark, sf_dir):
    raw_dir, c = _exported(spark, sf_dir, "order_reviews")
    df = csv_source.read_contract(spark, raw_dir, c, na_tokens=False, ordinal=False)
    return df.select("review_id", "order_id", "review_comment_title", "review_comment_message")


def q_src_na_tokens(spark, sf_dir):
    raw_dir, c = _exported(spark, sf_dir, "order_reviews")
    df = csv_source.read_contract(spark, raw_dir, c, na_tokens=True, ordinal=False)
    return df.select("review_id", "order_id", "review_comment_title", "review_comment_message")


def q_src_header_check(spark, sf_dir):
    """Payments file written with its columns in reverse order: values must land under their names."""
    c = BY_TABLE["order_payments"]
    raw_dir, _ = _exported(spark, sf_dir, "order_payments", columns=list(reversed(c.columns)))
    df = csv_source.conform(csv_source.read_contract(spark, raw_dir, c, ordinal=False), c)
    return _money_as_double(clean.transform_payments(df).select(*c.schema.fieldNames()))


def q_src_presence(spark, sf_dir):
    """S1 as data: every expected raw file, whether it is there, its header holds, and its records."""
    raw_dir = scratch_path(spark, "raw-all")
    mapping.export_raw_files(spark, sf_dir, raw_dir)
    return csv_source.presence_report(spark, raw_dir)


def q_src_mixed_headers(spark, sf_dir):
    """Payments as a folder whose part files have their columns in different orders."""
    c = BY_TABLE["order_payments"]
    raw_dir = scratch_path(spark, "raw-mixed")
    df = mapping.raw_frames(spark, sf_dir)["order_payments"]
    odd = F.col("order_id").cast("long") % 2 == 1
    mapping.write_csv(df.where(~odd).select(*c.columns), f"{raw_dir}/{c.file_name()}")
    mapping.write_csv(df.where(odd).select(*c.columns[:1], *reversed(c.columns[1:])), f"{raw_dir}/{c.file_name()}", mode="append")
    df = csv_source.conform(csv_source.read_contract(spark, raw_dir, c, ordinal=False), c)
    return _money_as_double(clean.transform_payments(df).select(*c.schema.fieldNames()))


def _bad_items(spark, sf_dir) -> tuple[str, object]:
    """Items file with values that do not fit their type and rows with a field too many."""
    c = BY_TABLE["order_items"]
    raw_dir = scratch_path(spark, "raw-rejects")
    key = F.col("order_id").cast("long")
    bad = mapping.raw_frames(spark, sf_dir)["order_items"].select(*c.columns).withColumns({
        "price": F.when(key % 19 == 0, F.concat(F.lit("EUR "), "price")).otherwise(F.col("price")),
        "freight_value": F.when(key % 7 == 0, "n/a").when(key % 23 == 0, "1e12").otherwise(F.col("freight_value")),
        "order_item_id": F.when(key % 31 == 0, "first").otherwise(F.col("order_item_id")),
    })
    plain, header = [F.coalesce(F.col(x), F.lit("")) for x in c.columns], ",".join(c.columns)
    lines = bad.select(F.concat_ws(",", *plain, F.when(key % 37 == 0, "surplus")).alias("value"))
    mapping.write_lines(lines, header, f"{raw_dir}/{c.file_name()}")
    return raw_dir, c


def q_src_rejects(spark, sf_dir):
    """Items with values that do not fit their type, by column, and rows with a field too many."""
    raw_dir, c = _bad_items(spark, sf_dir)
    raw = csv_source.read_contract(spark, raw_dir, c, ordinal=False, surplus=True)
    return csv_source.rejects_report(raw, c).select(F.lit(c.table).alias("table"), "column", "rejects")


def q_src_quarantine(spark, sf_dir):
    """Every value and record that a run would not take as it is, one row each."""
    raw_dir, c = _bad_items(spark, sf_dir)
    rows = csv_source.quarantined(csv_source.read_contract(spark, raw_dir, c, surplus=True), c)
    field = lambda name: F.get_json_object("record", f"$.{name}")
    return rows.select("table", "column", "reason", "value", field("order_id").alias("order_id"), field("product_id").alias("product_id"),
                       field("seller_id").alias("seller_id"), F.col("place").isNotNull().alias("placed"))


def q_t_geolocation(spark, sf_dir):
    """C6 and C13 through the CSV files, whose order decides which city and state come first."""
    c = BY_TABLE["geolocation"]
    raw_dir = scratch_path(spark, "raw-geolocation")
    mapping.write_raw(mapping.raw_frames(spark, sf_dir)["geolocation"], f"{raw_dir}/{c.file_name()}")
    df = csv_source.conform(csv_source.read_contract(spark, raw_dir, c), c)
    return clean.transform_geolocation(df).select(*c.schema.fieldNames())


def q_conform_types(spark, sf_dir):
    raw_dir, c = _exported(spark, sf_dir, "order_items")
    df = csv_source.conform(csv_source.read_contract(spark, raw_dir, c, ordinal=False), c)
    return _money_as_double(df)


# --------------------------------------------------------------------------- pipeline
# Raw files whose rows are cleaned one by one; in the others the places of records and file splits count too.
_ROW_BY_ROW = ("customers", "sellers", "products", "orders", "order_items", "order_payments")


def _pipeline_run(spark, sf_dir, gzipped=_ROW_BY_ROW):
    """(raw folder, warehouse folder, result) of a run of its own over freshly exported raw files."""
    base = scratch_path(spark, "pipeline")
    mapping.export_raw_files(spark, sf_dir, f"{base}/raw", gzipped=gzipped)
    return f"{base}/raw", f"{base}/warehouse", pipeline.run_pipeline(spark, f"{base}/raw", f"{base}/warehouse")


def _only_run(spark, sf_dir):
    """(warehouse folder, result) of a run whose raw files are read no more: they go when it is done."""
    raw, out, result = _pipeline_run(spark, sf_dir, (*_ROW_BY_ROW, "order_reviews"))
    remove_path(spark, raw)
    return out, result


def q_reconcile_counts(spark, sf_dir):
    _, result = _only_run(spark, sf_dir)
    return spark.createDataFrame([tuple(r) for r in result.reconciliation],
                                 "table string, expected long, loaded long, ok boolean")


def q_pipeline_row_counts(spark, sf_dir):
    """Records read, rows published and records dropped by deduplicating steps, per table."""
    _, result = _only_run(spark, sf_dir)
    return spark.createDataFrame([(t, *counts) for t, counts in result.row_counts.items()],
                                 "table string, raw_rows long, published_rows long, dropped_rows long")


def q_sink_empty_table(spark, sf_dir):
    """A run whose review file has a header and no records publishes the table with its contract's columns."""
    base = scratch_path(spark, "pipeline")
    mapping.export_raw_files(spark, sf_dir, f"{base}/raw", without=("order_reviews",))
    pipeline.run_pipeline(spark, f"{base}/raw", f"{base}/warehouse")
    parts = []
    for table, df in pipeline.warehouse(spark, f"{base}/warehouse").items():
        same = [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in BY_TABLE[table].schema.fields]
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(table).alias("table"), F.lit(len(df.columns)).cast("long").alias("columns"),
                                                                   F.lit(same).alias("as_declared"), "rows"))
    return reduce(DataFrame.unionAll, parts)


def q_load_order(spark, sf_dir):
    """The order in which a run takes its tables; every referenced table comes before those that refer to it."""
    _, result = _only_run(spark, sf_dir)
    order = list(result.row_counts)
    rows = [(place, t, all(order.index(parent) < place for _, parent, _ in BY_TABLE[t].foreign_keys), len(BY_TABLE[t].foreign_keys), result.row_counts[t][1])
            for place, t in enumerate(order)]
    return spark.createDataFrame(rows, "position long, table string, after_its_references boolean, references long, rows long")


def q_pipeline_end_to_end(spark, sf_dir):
    out, _ = _only_run(spark, sf_dir)
    return marts.mart_monthly_revenue(pipeline.warehouse(spark, out))


_SPLIT_BYTES = 128 << 20  # Spark's default size of a file split


def q_sink_overwrite_idempotent(spark, sf_dir):
    """Second full run into the same warehouse, with another number of partitions: every published table
    must be identical to run one. Its file splits are smaller than those of run one, in proportion to them."""
    raw, out, first = _pipeline_run(spark, sf_dir)
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", str(int(spark.conf.get("spark.sql.shuffle.partitions")) * 2 + 1))
    other.conf.set("spark.sql.files.maxPartitionBytes", f"{_SPLIT_BYTES // 3}b")
    other.conf.set("spark.sql.files.openCostInBytes", "64k")
    other.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism * 3 + 1))
    second = pipeline.run_pipeline(other, raw, out)
    remove_path(spark, raw)
    rows = []
    for t in parquet_sink.read_warehouse(spark, out):
        a = spark.read.parquet(f"{parquet_sink.run_dir(out, first.run_id)}/{t}")
        b = spark.read.parquet(f"{parquet_sink.run_dir(out, second.run_id)}/{t}")
        digest = [F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*a.columns).cast("decimal(38,0)")).alias("h")]
        ra, rb = a.agg(*digest).first(), b.agg(*digest).first()
        rows.append((t, ra["n"], ra["n"] == rb["n"] and ra["h"] == rb["h"]))
    return spark.createDataFrame(rows, "table string, rows long, identical boolean")


# --------------------------------------------------------------------------- integrity checks
def q_dq_unique(spark, sf_dir):
    d = quality.duplicate_keys(mapping.m_items(spark, sf_dir), ["order_id", "order_item_id"])
    return d.select("order_id", "order_item_id", F.col("n").cast("long"))


def q_dq_foreign_key(spark, sf_dir):
    p = mapping.m_products(spark, sf_dir)
    return quality.orphans(p, ["product_category_name"], mapping.m_translation(spark, sf_dir),
                           ["product_category_name"]).select("product_id", "product_category_name")


def q_dq_not_null(spark, sf_dir):
    cols = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
            "order_delivered_customer_date", "order_estimated_delivery_date"]
    return quality.null_counts(mapping.m_orders(spark, sf_dir), cols)


def q_dq_domain(spark, sf_dir):
    a = quality.domain_counts(mapping.m_customers(spark, sf_dir), BY_TABLE["customers"])
    b = quality.domain_counts(mapping.m_items(spark, sf_dir), BY_TABLE["order_items"])
    return (a.select(F.lit("customers").alias("table"), "*")
            .unionByName(b.select(F.lit("order_items").alias("table"), "*")))


# --------------------------------------------------------------------------- single primitives
def q_win_lag(spark, sf_dir):
    """W1 on its own: orders per purchase month (all statuses) and the previous present month's count."""


    o = _t(spark, sf_dir)["orders"]
    m = o.groupBy(month_floor("order_purchase_timestamp").alias("m")).agg(F.count(F.lit(1)).alias("orders"))
    return m.select(month_label("m").alias("order_month"), F.col("orders").cast("long"),
                    F.lag("orders").over(Window.orderBy("m")).cast("long").alias("prev_orders"))


def q_win_first_value(spark, sf_dir):
    """W2 on its own: every (cohort, offset) with the cohort's first (offset-0) size."""
    cc = marts.cohort_counts(_t(spark, sf_dir))
    first = F.first("active_customers").over(Window.partitionBy("cohort").orderBy("month_offset"))
    return cc.select(F.date_format("cohort", "yyyy-MM-dd").alias("cohort_month"),
                     F.col("month_offset").cast("long"), F.col("active_customers").cast("long"),
                     first.cast("long").alias("cohort_size"))


def q_filter_equality(spark, sf_dir):
    return marts.delivered_orders(_t(spark, sf_dir)).select("order_id", "order_purchase_timestamp")


def q_share_true(spark, sf_dir):
    """Late share per state among delivered, dated orders; NULL estimates are skipped."""
    o = marts.delivered_orders(_t(spark, sf_dir)).where(F.col("order_delivered_customer_date").isNotNull())
    c = _t(spark, sf_dir)["customers"].select("customer_id", "customer_state")
    late = F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
    return o.join(c, "customer_id").groupBy("customer_state").agg(publish(share_true(late)).alias("late_share"))


def q_agg_count_distinct(spark, sf_dir):
    items = _t(spark, sf_dir)["order_items"]
    return items.groupBy("seller_id").agg(F.count_distinct("order_id").cast("long").alias("orders"))


def q_scalar_subquery_recency(spark, sf_dir):
    """days from each person's last delivered purchase to the latest purchase of any order."""
    t = _t(spark, sf_dir)
    max_ts = t["orders"].select(F.max("order_purchase_timestamp")).scalar()
    people = marts.person_totals(t)
    return people.select("customer_unique_id",
                     F.datediff(max_ts.cast("date"), F.col("last_purchase").cast("date")).alias("recency_days"))


def q_datediff_average(spark, sf_dir):
    """Average whole days from purchase to delivery per purchase month (scale 4, then 1 digit)."""
    o = marts.delivered_orders(_t(spark, sf_dir)).where(F.col("order_delivered_customer_date").isNotNull())
    g = o.groupBy(month_floor("order_purchase_timestamp").alias("m")).agg(
        avg_exact(days_between("order_delivered_customer_date", "order_purchase_timestamp")).alias("a"))
    return g.select(month_label("m").alias("order_month"), rounded("a", 1).alias("avg_delivery_days"))


def q_mean_of_ratios(spark, sf_dir):
    """Mean of per-item freight/price (NULL for price 0) x 100 per seller state, all items."""
    t = _t(spark, sf_dir)
    items = t["order_items"]
    fs = marts._scale(items, "freight_value")
    ratio = dec_ratio(F.col("freight_value"), F.col("price"), fs + 4, fs, marts._scale(items, "price"))
    s = t["sellers"].select("seller_id", "seller_state")
    g = items.join(s, "seller_id").groupBy("seller_state").agg(F.avg(ratio).alias("r"))
    return g.select("seller_state", rounded(F.col("r") * 100, 1).alias("freight_pct_of_price"))


def q_topk(spark, sf_dir):
    """O3: ten products with the highest item revenue; ties broken by product id."""
    items = _t(spark, sf_dir)["order_items"]
    g = items.groupBy("product_id").agg(F.sum("price").alias("revenue"))
    return g.orderBy(F.col("revenue").desc(), "product_id").limit(10).select(
        "product_id", publish("revenue").alias("revenue"))


def q_month_label(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    return o.select("order_id", month_label(month_floor("order_purchase_timestamp")).alias("order_month"))


def q_month_floor(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"]
    return o.select("order_id", F.date_format(month_floor("order_purchase_timestamp"), "yyyy-MM-dd").alias("month_start"))


def q_month_offset(spark, sf_dir):
    o = _t(spark, sf_dir)["orders"].where(F.col("order_estimated_delivery_date").isNotNull())
    off = month_offset(month_floor("order_purchase_timestamp"), month_floor("order_estimated_delivery_date"))
    return o.select("order_id", off.cast("long").alias("month_offset"))


def q_safe_growth_pct(spark, sf_dir):
    """Month-over-month growth of delivered item revenue with a NULL-safe denominator."""


    m = marts.monthly_revenue_base(_t(spark, sf_dir))
    prev = F.lag("rev").over(Window.orderBy("m"))
    g = F.round(dec_div(F.lit(100) * (F.col("rev") - prev), prev, 6, num_scale=2, den_scale=2), 1)
    return m.select(month_label("m").alias("order_month"), publish(g).alias("growth_pct"))


def q_join_left_dimension(spark, sf_dir):
    """Every product with its label: english, else native, else 'uncategorized'."""
    return marts.category_labels(_t(spark, sf_dir))


def q_top_categories_collated(spark, sf_dir):
    """M2 under a case-insensitive collation: names in mixed case are one category, translated or not."""
    t = _t(spark, sf_dir)
    name = F.col("product_category_name")
    spelled = F.when(F.col("product_id") % 3 == 0, F.upper(name)).when(F.col("product_id") % 3 == 1, F.lower(name)).otherwise(name)
    t["products"] = t["products"].withColumn("product_category_name", spelled)
    rows = t["product_category_translation"].withColumn("_file_order", F.col("product_category_name_english"))
    twice = rows.unionByName(rows.withColumns({"product_category_name": F.upper("product_category_name"),
                                               "product_category_name_english": F.lit("later spelling"), "_file_order": F.lit("~")}))
    t["product_category_translation"] = clean.transform_category_translation(twice, "UTF8_LCASE")
    return marts.mart_top_categories(t, collation="UTF8_LCASE")


QUERIES: dict[str, Query] = {
    "mart_monthly_revenue": _mart(marts.mart_monthly_revenue),
    "mart_top_categories": _mart(marts.mart_top_categories),
    "mart_delivery_by_state": _mart(marts.mart_delivery_by_state),
    "mart_cohort_retention": _mart(marts.mart_cohort_retention),
    "mart_rfm_segments": _mart(marts.mart_rfm_segments),
    "mart_seller_ranking": _mart(marts.mart_seller_ranking),
    "mart_payment_mix": _mart(marts.mart_payment_mix),
    "mart_installment_buckets": _mart(marts.mart_installment_buckets),
    "mart_delay_vs_reviews": _mart(marts.mart_delay_vs_reviews),
    "mart_repeat_rate": _mart(marts.mart_repeat_rate),
    "mart_order_histogram": _mart(marts.mart_order_histogram),
    "mart_freight_by_region": _mart(marts.mart_freight_by_region),
    "win_ntile": q_win_ntile,
    "rfm_scores": q_rfm_scores,
    "win_dense_rank_hot": q_win_dense_rank_hot,
    "top_categories_collated": q_top_categories_collated,
    "win_dense_rank": _mart(marts.mart_seller_dense_rank),
    "win_share_of_total": _mart(marts.mart_category_share),
    "having_min_volume": _mart(marts.mart_delivery_by_state, min_orders=180),
    "join_fanout_average": q_join_fanout_average,
    "case_bucket": q_case_bucket,
    "clean_text": q_clean_text,
    "clean_state": q_clean_state,
    "clean_to_datetime": q_clean_to_datetime,
    "clean_rename": q_clean_rename,
    "t_customers": _transform("customers"),
    "t_sellers": _transform("sellers"),
    "t_orders": _transform("orders"),
    "t_order_items": _transform("order_items"),
    "t_payments": _transform("order_payments"),
    "t_products": _transform("products"),
    "t_order_reviews": _transform("order_reviews"),
    "dedup_full_row": q_dedup_full_row,
    "dedup_keep_latest": q_dedup_keep_latest,
    "dedup_keep_first": q_dedup_keep_first,
    "geo_collapse": q_geo_collapse,
    "t_geolocation": q_t_geolocation,
    "src_presence": q_src_presence,
    "src_csv_scan": q_src_csv_scan,
    "src_na_tokens": q_src_na_tokens,
    "src_header_check": q_src_header_check,
    "src_mixed_headers": q_src_mixed_headers,
    "src_rejects": q_src_rejects,
    "src_quarantine": q_src_quarantine,
    "conform_types": q_conform_types,
    "reconcile_counts": q_reconcile_counts,
    "pipeline_row_counts": q_pipeline_row_counts,
    "sink_empty_table": q_sink_empty_table,
    "load_order": q_load_order,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "sink_overwrite_idempotent": q_sink_overwrite_idempotent,
    "dq_unique": q_dq_unique,
    "dq_foreign_key": q_dq_foreign_key,
    "dq_not_null": q_dq_not_null,
    "dq_domain": q_dq_domain,
    "win_lag": q_win_lag,
    "win_first_value": q_win_first_value,
    "filter_equality": q_filter_equality,
    "share_true": q_share_true,
    "agg_count_distinct": q_agg_count_distinct,
    "scalar_subquery_recency": q_scalar_subquery_recency,
    "datediff_average": q_datediff_average,
    "mean_of_ratios": q_mean_of_ratios,
    "topk": q_topk,
    "month_label": q_month_label,
    "month_floor": q_month_floor,
    "month_offset": q_month_offset,
    "safe_growth_pct": q_safe_growth_pct,
    "join_left_dimension": q_join_left_dimension,
}

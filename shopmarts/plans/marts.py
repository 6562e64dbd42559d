"""The twelve analytical marts (M1-M12) over the order model.

Each mart is ``mart_x(t, **params) -> DataFrame`` where ``t`` maps table names to DataFrames
(``mapping.model_tables`` or a published warehouse). Plans are written for large fact tables:

* facts are aggregated to the grain of the next join before joining (items per order, reviews per
  order), so a fan-out never materialises and a hot key is collapsed by the map-side partial
  aggregate before it is shuffled;
* COUNT(DISTINCT order) becomes COUNT(*) once the rows are one per order;
* shares of a total are windows over the few rows of an aggregate, never over its input;
* global ranking uses the range-parallel operators in ``operators.ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.functions.exprs import (
    as_int, avg_exact, dec_div, dec_ratio, days_between, month_floor, month_label, month_offset,
    pct, publish, rounded, share_true,
)
from shopmarts.operators import ranking
from shopmarts.session import cut_lineage

Tables = dict[str, DataFrame]


def _scale(df: DataFrame, column: str) -> int:
    dt = df.schema[column].dataType
    return getattr(dt, "scale", 0)


# --------------------------------------------------------------------------- shared building blocks
def delivered_orders(t: Tables) -> DataFrame:
    o = t["orders"]
    return o.where(F.col("order_status") == "delivered")


def items_per_order(t: Tables) -> DataFrame:
    """order_id -> item count, Σ price, Σ freight (partial aggregation before the shuffle)."""
    return t["order_items"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("price_sum"),
        F.sum("freight_value").alias("freight_sum"))


def orders_with_person(t: Tables, delivered_only: bool) -> DataFrame:
    """order_id, purchase ts, customer_unique_id (customer_id is per order; the person is unique_id)."""
    o = delivered_orders(t) if delivered_only else t["orders"]
    c = t["customers"].select("customer_id", "customer_unique_id")
    return o.select("order_id", "customer_id", "order_purchase_timestamp").join(c, "customer_id").drop("customer_id")


# --------------------------------------------------------------------------- M1
def monthly_revenue_base(t: Tables) -> DataFrame:
    """Per purchase month of delivered orders that have items: orders, Σ price, Σ freight."""
    per_order = delivered_orders(t).select("order_id", month_floor("order_purchase_timestamp").alias("m"))
    return (per_order.join(items_per_order(t), "order_id")
            .groupBy("m").agg(F.count(F.lit(1)).alias("orders"), F.sum("price_sum").alias("rev"),
                              F.sum("freight_sum").alias("freight")))


def mart_monthly_revenue(t: Tables) -> DataFrame:
    """M1: one row per month; LAG over the (few) month rows is a single small window."""
    monthly = monthly_revenue_base(t).select(
        "m", F.col("orders").cast("long").alias("orders"),
        F.round("rev", 2).alias("product_revenue"), F.round("freight", 2).alias("freight_revenue"))
    w = Window.orderBy("m")
    prev = F.lag("product_revenue").over(w)
    growth = F.round(dec_div(F.lit(100) * (F.col("product_revenue") - prev), prev, 6, num_scale=2, den_scale=2), 1)
    return monthly.select(
        month_label("m").alias("order_month"), "orders",
        publish("product_revenue").alias("product_revenue"), publish("freight_revenue").alias("freight_revenue"),
        publish(prev).alias("prev_month_revenue"), publish(growth).alias("mom_growth_pct"),
    ).orderBy("order_month")


# --------------------------------------------------------------------------- M2
def category_labels(t: Tables, collation: str | None = None) -> DataFrame:
    """product_id -> category label: english name, else native name, else 'uncategorized'."""
    name = F.col("product_category_name")
    key = (F.collate(name, collation) if collation else name).alias("_k")
    p = t["products"].select("product_id", name, key)
    tr = t["product_category_translation"].select(key, "product_category_name_english")
    label = F.coalesce("product_category_name_english", "product_category_name", F.lit("uncategorized"))
    return p.join(tr, "_k", "left").select("product_id", label.alias("category"))


def collated_labels(labels: DataFrame, collation: str) -> DataFrame:
    """category -> its group (the least spelling that the collation holds equal) and its number in it."""
    spellings = Window.partitionBy(F.collate("category", collation)).orderBy(F.col("category"))
    return labels.select("category").distinct().select(
        "category", F.first("category").over(spellings).alias("group"), F.row_number().over(spellings).alias("spelling"))


def category_revenue(t: Tables, collation: str | None = None) -> DataFrame:
    """category label -> distinct delivered orders and Σ price (all groups, before any limit).

    ``collation`` (e.g. 'UNICODE_CI_AI') compares names as a case-insensitive warehouse would (T15), in
    the translation lookup and in the grouping, which shows the least spelling; the default compares bytes.
    Facts carry the group and the number of the spelling, so their aggregates stay hash aggregates; the
    spelling itself is looked up for the finished groups.
    """
    items = t["order_items"].select("order_id", "product_id", "price")
    delivered = delivered_orders(t).select("order_id")
    labels = category_labels(t, collation)
    keys, least = ["category"], []
    if collation:
        spelled = collated_labels(labels, collation)
        labels = labels.join(spelled, "category").select("product_id", "group", "spelling")
        keys, least = ["group"], [F.min("spelling").alias("spelling")]
    labelled = items.join(delivered, "order_id", "left_semi").join(labels, "product_id")
    # distinct (category, order) first: COUNT(DISTINCT order) without an Expand of every item row
    per_order = labelled.groupBy(*keys, "order_id").agg(F.sum("price").alias("price"), *least)
    groups = per_order.groupBy(*keys).agg(F.count(F.lit(1)).cast("long").alias("orders"), F.sum("price").alias("rev"), *least)
    if collation:
        groups = groups.join(spelled, ["group", "spelling"])
    return groups.select("category", "orders", "rev")


def with_share(df: DataFrame, value: str, out: str, digits: int) -> DataFrame:
    """100 * value / Σ value over all rows of an aggregate (a window over its few group rows, so
    the data below is read once)."""
    total = F.sum(value).over(Window.partitionBy())
    vs = _scale(df, value)
    share = F.round(dec_div(F.lit(100) * F.col(value), total, vs + 4, num_scale=vs, den_scale=vs), digits)
    return df.withColumn(out, publish(share))


def mart_category_share(t: Tables, collation: str | None = None) -> DataFrame:
    """Every category with its revenue share (W5 without the top-k cut)."""
    cats = with_share(category_revenue(t, collation), "rev", "revenue_share_pct", 2)
    return cats.select("category", "orders", rounded("rev", 2).alias("revenue"), "revenue_share_pct")


def mart_top_categories(t: Tables, limit: int = 15, collation: str | None = None) -> DataFrame:
    """M2: top categories by revenue; share over all groups, computed before the limit."""
    cats = with_share(category_revenue(t, collation), "rev", "revenue_share_pct", 2)
    top = cats.orderBy(F.col("rev").desc(), F.col("category").asc()).limit(limit)
    return top.select("category", "orders", rounded("rev", 2).alias("revenue"), "revenue_share_pct")


# --------------------------------------------------------------------------- M3
def mart_delivery_by_state(t: Tables, min_orders: int = 100) -> DataFrame:
    """M3: delivery days, days before estimate and late share per customer state."""
    o = delivered_orders(t).where(F.col("order_delivered_customer_date").isNotNull())
    c = t["customers"].select("customer_id", "customer_state")
    d, p, e = "order_delivered_customer_date", "order_purchase_timestamp", "order_estimated_delivery_date"
    rows = o.join(c, "customer_id").select(
        "customer_state", days_between(d, p).alias("dd"), days_between(e, d).alias("de"),
        (F.col(d) > F.col(e)).alias("late"))
    g = rows.groupBy("customer_state").agg(
        F.count(F.lit(1)).alias("delivered_orders"), avg_exact("dd").alias("a1"), avg_exact("de").alias("a2"),
        share_true("late").alias("late"))
    return (g.where(F.col("delivered_orders") >= min_orders)
            .select("customer_state", F.col("delivered_orders").cast("long"),
                    rounded("a1", 1).alias("avg_delivery_days"), rounded("a2", 1).alias("avg_days_before_estimate"),
                    rounded(F.lit(100) * F.col("late"), 2).alias("late_delivery_pct"))
            .orderBy(F.col("late_delivery_pct").desc_nulls_last(), "customer_state"))


# --------------------------------------------------------------------------- M4
def cohort_counts(t: Tables) -> DataFrame:
    """(cohort month, month offset) -> distinct active people, from distinct (person, month) pairs.

    Orders collapse to one row per (person, month) by partial aggregation first, so a person with a
    huge order history costs at most one row per calendar month from there on.
    """
    owc = orders_with_person(t, delivered_only=True)
    pm = owc.select("customer_unique_id", month_floor("order_purchase_timestamp").alias("m")).distinct()
    first = F.min("m").over(Window.partitionBy("customer_unique_id"))
    act = pm.select(first.alias("cohort"), "m").select("cohort", month_offset("cohort", "m").alias("month_offset"))
    return act.groupBy("cohort", "month_offset").agg(F.count(F.lit(1)).alias("active_customers"))


def mart_cohort_retention(t: Tables, max_offset: int = 6) -> DataFrame:
    """M4: retention % of each cohort's offset-0 size; the offset filter applies before the window."""
    cc = cohort_counts(t).where(F.col("month_offset") <= max_offset)
    w = Window.partitionBy("cohort").orderBy("month_offset")
    base = F.first("active_customers").over(w)
    ret = F.round(dec_div(F.lit(100) * F.col("active_customers"), base, 4), 2)
    return cc.select(F.date_format("cohort", "yyyy-MM-dd").alias("cohort_month"),
                     F.col("month_offset").cast("long").alias("month_offset"),
                     F.col("active_customers").cast("long").alias("active_customers"),
                     publish(ret).alias("retention_pct")).orderBy("cohort_month", "month_offset")


# --------------------------------------------------------------------------- M5
def person_totals(t: Tables) -> DataFrame:
    """Per person over delivered orders with items: last purchase, distinct orders, Σ(price + freight)."""
    per_order = t["order_items"].groupBy("order_id").agg(
        F.sum(F.col("price") + F.col("freight_value")).alias("order_value"))
    owc = orders_with_person(t, delivered_only=True)
    return owc.join(per_order, "order_id").groupBy("customer_unique_id").agg(
        F.max("order_purchase_timestamp").alias("last_purchase"),
        F.count(F.lit(1)).alias("frequency"), F.sum("order_value").alias("monetary"))


RFM_ORDERS = {"r_score": "last_purchase", "f_score": "frequency", "m_score": "monetary"}


def rfm_scores(t: Tables, tiles: int = 5, scores=tuple(RFM_ORDERS), ranges: int | None = None) -> DataFrame:
    """The scored relation: recency days plus NTILE scores (ties broken by the person id).

    Runs one job while it is built: the person totals are checkpointed, because the score cuts read them.
    """
    people = cut_lineage(person_totals(t))
    max_ts = t["orders"].select(F.max("order_purchase_timestamp")).scalar()
    scored = ranking.global_ntiles(people, tiles, {s: [RFM_ORDERS[s], "customer_unique_id"] for s in scores}, ranges=ranges)
    return scored.withColumn("recency_days", F.datediff(max_ts.cast("date"), F.col("last_purchase").cast("date")))


# Segment labels by recency and frequency score (high: 4 and up, low: 2 and down).
HIGH_SCORE, LOW_SCORE = 4, 2


def segment_label(r, f) -> F.Column:
    r, f = F.col(r), F.col(f)
    recent, old, often, seldom = r >= HIGH_SCORE, r <= LOW_SCORE, f >= HIGH_SCORE, f <= LOW_SCORE
    return (F.when(recent & often, "champions").when(recent & seldom, "promising_new")
            .when(old & often, "at_risk_loyal").when(old & seldom, "hibernating").otherwise("regular"))


def mart_rfm_segments(t: Tables, ranges: int | None = None) -> DataFrame:
    """M5: segment sizes and averages; no label uses the money score, so it is not computed here."""
    scored = rfm_scores(t, scores=("r_score", "f_score"), ranges=ranges)
    g = scored.groupBy(segment_label("r_score", "f_score").alias("segment")).agg(
        F.count(F.lit(1)).cast("long").alias("customers"), avg_exact("recency_days").alias("ar"),
        avg_exact("frequency").alias("af"), avg_exact("monetary", _scale(scored, "monetary")).alias("am"))
    return g.select("segment", "customers", rounded("ar", 0).alias("avg_recency_days"),
                    rounded("af", 2).alias("avg_frequency"), rounded("am", 2).alias("avg_monetary")
                    ).orderBy(F.col("customers").desc(), "segment")


# --------------------------------------------------------------------------- M6
def seller_stats(t: Tables) -> DataFrame:
    """Per seller: delivered orders, delivered revenue, item-weighted review average (all statuses).

    Items collapse to (order, seller) and reviews to one row per order before the join, so the
    item x review fan-out is never built: Σ n_items * Σ score / Σ n_items * n_reviews is the same mean.
    """
    os_ = t["order_items"].groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum("price").alias("price_sum"))
    status = t["orders"].select("order_id", (F.col("order_status") == "delivered").alias("delivered"))
    rev = t["order_reviews"].groupBy("order_id").agg(F.sum("review_score").alias("score_sum"),
                                                     F.count("review_score").alias("n_reviews"))
    rows = os_.join(status, "order_id", "left").join(rev, "order_id", "left")
    dlv = F.coalesce(F.col("delivered"), F.lit(False))
    return rows.groupBy("seller_id").agg(
        F.sum(F.when(dlv, 1).otherwise(0)).alias("orders"),
        F.sum(F.when(dlv, F.col("price_sum"))).alias("revenue_raw"),
        F.sum(F.col("n_items") * F.col("score_sum")).alias("w_score"),
        F.sum(F.col("n_items") * F.col("n_reviews")).alias("w_count"))


def seller_ranking_base(t: Tables, min_orders: int = 10) -> DataFrame:
    s = t["sellers"].select("seller_id", "seller_state")
    st = seller_stats(t).where(F.col("orders") >= min_orders)
    return st.join(s, "seller_id").select(
        "seller_id", "seller_state", F.col("orders").cast("long").alias("orders"),
        F.round("revenue_raw", 2).alias("revenue"),
        rounded(dec_div("w_score", "w_count", 4), 2).alias("avg_review_score"))


def mart_seller_ranking(t: Tables, min_orders: int = 10, limit: int = 20) -> DataFrame:
    """M6: top sellers by revenue with dense rank (top-k first, then rank the k rows)."""
    top = ranking.top_dense_rank(seller_ranking_base(t, min_orders), "revenue", "seller_id", limit, "revenue_rank")
    return top.select("seller_id", "seller_state", "orders", publish("revenue").alias("revenue"),
                      "avg_review_score", F.col("revenue_rank").cast("long").alias("revenue_rank")
                      ).orderBy("revenue_rank", "seller_id")


def mart_seller_dense_rank(t: Tables, min_orders: int = 10, ranges: int | None = None) -> DataFrame:
    """W4 over all qualifying sellers (no limit), range-parallel; runs its checkpoints while it is built."""
    base = cut_lineage(seller_ranking_base(t, min_orders).select("seller_id", "revenue"))  # read twice
    ranked = ranking.global_dense_rank(base, "revenue", "revenue_rank", descending=True, ranges=ranges)
    return ranked.select("seller_id", publish("revenue").alias("revenue"),
                         F.col("revenue_rank").cast("long").alias("revenue_rank"))


# --------------------------------------------------------------------------- M7 / M8
def mart_payment_mix(t: Tables) -> DataFrame:
    """M7: all payments in one scan; the share (W6) is taken over the aggregate's rows."""
    p = t["order_payments"]
    vs = _scale(p, "payment_value")
    g = p.groupBy("payment_type").agg(
        F.count(F.lit(1)).alias("payments"), avg_exact("payment_installments").alias("ai"),
        avg_exact("payment_value", vs).alias("av"), F.sum("payment_value").alias("tv"))
    g = with_share(g, "payments", "share_pct", 2)
    return g.select("payment_type", F.col("payments").cast("long"), "share_pct",
                    rounded("ai", 2).alias("avg_installments"), rounded("av", 2).alias("avg_payment_value"),
                    rounded("tv", 2).alias("total_value")).orderBy(F.col("total_value").desc(), "payment_type")


# Instalment buckets, upper bound inclusive, first match wins.
INSTALLMENT_BUCKETS = (("1_single", 1), ("2_to_3", 3), ("4_to_6", 6), ("7_to_12", 12))
INSTALLMENT_ELSE = "13_plus"


def installment_bucket(n) -> F.Column:
    n = F.col(n) if isinstance(n, str) else n
    expr = F.when(n == 1, INSTALLMENT_BUCKETS[0][0])
    for label, upper in INSTALLMENT_BUCKETS[1:]:
        expr = expr.when(n <= upper, label)
    return expr.otherwise(INSTALLMENT_ELSE)


def mart_installment_buckets(t: Tables, payment_type: str = "credit_card") -> DataFrame:
    """M8: credit-card payments by instalment bucket; 0 instalments fall into '2_to_3' (T13)."""
    p = t["order_payments"].where(F.col("payment_type") == payment_type)
    g = p.groupBy(installment_bucket("payment_installments").alias("installment_bucket")).agg(
        F.count(F.lit(1)).cast("long").alias("payments"),
        avg_exact("payment_value", _scale(p, "payment_value")).alias("av"))
    order = [label for label, _ in INSTALLMENT_BUCKETS] + [INSTALLMENT_ELSE]
    ordinal = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("installment_bucket"))
    return g.select("installment_bucket", "payments", rounded("av", 2).alias("avg_payment_value")).orderBy(ordinal)


# --------------------------------------------------------------------------- M9
def delay_bucket(days) -> F.Column:
    """Days late to a label; the first match wins and NULL falls to the last label."""
    d = F.col(days) if isinstance(days, str) else days
    # Bucket labels and bounds.
    return (F.when(d <= -7, "1_week_plus_early").when(d < 0, "2_early").when(d == 0, "3_on_time")
            .when(d <= 3, "4_late_1_to_3d").when(d <= 7, "5_late_4_to_7d").otherwise("6_late_8d_plus"))


def mart_delay_vs_reviews(t: Tables) -> DataFrame:
    """M9: rows are (order, review) pairs; reviews are pre-aggregated per order, then joined 1:1."""
    d = (delivered_orders(t).where(F.col("order_delivered_customer_date").isNotNull())
         .select("order_id", delay_bucket(days_between("order_delivered_customer_date",
                                                       "order_estimated_delivery_date")).alias("delivery_bucket")))
    r = t["order_reviews"].groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("review_score").alias("scored"), F.sum("review_score").alias("s"),
        F.sum(as_int(F.col("review_score") == 1)).alias("ones"))
    g = d.join(r, "order_id").groupBy("delivery_bucket").agg(
        *[F.sum(c).alias(c) for c in ("n", "scored", "s", "ones")])
    return g.select("delivery_bucket", F.col("n").cast("long").alias("orders"),
                    rounded(dec_div("s", "scored", 4), 2).alias("avg_review_score"),
                    rounded(F.lit(100) * dec_div("ones", "scored", 4), 1).alias("pct_one_star")).orderBy("delivery_bucket")


# --------------------------------------------------------------------------- M10 / M11
def orders_per_person(t: Tables) -> DataFrame:
    """All statuses: person -> orders (order and customer ids are keys, so rows are one per order)."""
    owc = orders_with_person(t, delivered_only=False)
    return owc.groupBy("customer_unique_id").agg(F.count(F.lit(1)).alias("order_count"))


def mart_repeat_rate(t: Tables) -> DataFrame:
    """One global row; SUM(order_count > 1) is NULL on empty input, like SQL SUM."""
    pc = orders_per_person(t)
    g = pc.agg(F.count(F.lit(1)).alias("total_customers"),
               F.sum(as_int(F.col("order_count") > 1)).alias("repeat_customers"),
               F.max("order_count").alias("max_orders_one_customer"))
    return g.select(F.col("total_customers").cast("long"), F.col("repeat_customers").cast("long"),
                    pct("repeat_customers", "total_customers", 2).alias("repeat_rate_pct"),
                    F.col("max_orders_one_customer").cast("long"))


def mart_order_histogram(t: Tables) -> DataFrame:
    """How many people placed n orders."""
    return (orders_per_person(t).groupBy("order_count").agg(F.count(F.lit(1)).cast("long").alias("customers"))
            .select(F.col("order_count").cast("long"), "customers").orderBy("order_count"))


# --------------------------------------------------------------------------- M12
def mart_freight_by_region(t: Tables, min_orders: int = 100) -> DataFrame:
    """Per customer state, averages per item; same-state share per item (NULL compares skipped).

    Items collapse to (order, seller) and meet their order's state once. The first seller of each order
    carries the order, so sums and order counts come out of the same aggregates: by (state, seller), which
    is small, before sellers are joined for the same-state share, then by state. Seller references hold
    (the S12 gate).
    """
    items = t["order_items"]
    fs = _scale(items, "freight_value")
    ratio = dec_ratio(F.col("freight_value"), F.col("price"), fs + 4, fs, _scale(items, "price"))
    s = t["sellers"].select("seller_id", "seller_state")
    state = delivered_orders(t).select("order_id", "customer_id").join(
        t["customers"].select("customer_id", "customer_state"), "customer_id").select("order_id", "customer_state")
    per_seller = items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("n_items"), F.count("freight_value").alias("f_n"), F.sum("freight_value").alias("f_sum"),
        F.sum(ratio).alias("r_sum"), F.count(ratio).alias("r_n"))
    sums = ["n_items", "f_n", "f_sum", "r_sum", "r_n", "orders"]
    first = as_int(F.row_number().over(Window.partitionBy("order_id").orderBy("seller_id")) == 1)
    joined = per_seller.join(state, "order_id").withColumn("orders", first)
    pairs = joined.groupBy("customer_state", "seller_id").agg(*[F.sum(c).alias(c) for c in sums]).join(s, "seller_id")
    same = as_int(F.col("seller_state") == F.col("customer_state"))
    g = pairs.groupBy("customer_state").agg(
        *[F.sum(c).alias(c) for c in sums], F.sum(F.col("n_items") * same).alias("same_n"),
        F.sum(F.when(same.isNotNull(), F.col("n_items"))).alias("cmp_n")).where(F.col("orders") >= min_orders)
    return (g.select(
        "customer_state", F.col("orders").cast("long"),
        rounded(dec_div("f_sum", "f_n", fs + 4, num_scale=fs), 2).alias("avg_freight"),
        rounded(dec_div("r_sum", "r_n", fs + 8, num_scale=fs + 4) * 100, 1).alias("freight_pct_of_price"),
        rounded(F.lit(100) * dec_div("same_n", "cmp_n", 4), 1).alias("same_state_shipment_pct"))
        .orderBy(F.col("avg_freight").desc(), "customer_state"))

"""Independent SQL statements (DuckDB dialect) for every checkable query key.

They restate each operator in plain SQL over the driver tables, through the mapping views of
FIXTURES.md §4. DuckDB divides decimals in DOUBLE, so MySQL-style exact quotients (``scale + 4``
digits, half up) are written here with integer arithmetic: ``hu(num, den, k)`` is
round_half_up(num * 10^k / den) as an integer, and ``dec(q, s)`` puts it back at scale ``s``.
"""

from __future__ import annotations

# Text that a CSV reader of the pandas kind takes for a missing value.
MISSING = ("", "NA", "N/A", "n/a", "<NA>", "#N/A", "#N/A N/A", "#NA", "NULL", "null", "None", "NaN", "nan", "-NaN", "-nan",
           "1.#IND", "-1.#IND", "1.#QNAN", "-1.#QNAN")

SELLER_OF_ITEM = """CASE WHEN l_suppkey % 25 = 7 AND l_orderkey % 211 <> 0 THEN l_suppkey - 1
                         WHEN l_suppkey % 25 = 9 AND l_orderkey % 11 <> 0 THEN l_suppkey - 1 ELSE l_suppkey END"""
CATEGORY_OF_PART = "p_type || ' ' || CAST(p_partkey % 4 AS VARCHAR)"

MAPPING = f"""
m_orders AS (
  SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderstatus='F' AND o_orderkey % 29 <> 0
         THEN o_orderdate + CAST(o_orderkey*37 % 40 AS INT) * INTERVAL '1' DAY END AS order_delivered_customer_date,
    CASE WHEN o_orderkey % 31 <> 0
         THEN o_orderdate + CAST(15 + o_orderkey*13 % 15 AS INT) * INTERVAL '1' DAY END AS order_estimated_delivery_date
  FROM orders),
m_customers AS (
  SELECT o_orderkey AS customer_id, o_custkey AS customer_unique_id,
    c_nationkey AS customer_zip_code_prefix, n_name AS customer_state
  FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey),
m_sellers AS (
  SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix, n_name AS seller_state
  FROM supplier JOIN nation ON s_nationkey=n_nationkey),
m_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 17 <> 0 THEN {CATEGORY_OF_PART} END AS product_category_name FROM part),
m_translation AS (
  SELECT DISTINCT {CATEGORY_OF_PART} AS product_category_name, LOWER({CATEGORY_OF_PART}) AS product_category_name_english
  FROM part WHERE p_type <> 'PROMO'),
m_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, {SELLER_OF_ITEM} AS seller_id,
    l_shipdate AS shipping_limit_date,
    CAST(CASE WHEN l_suppkey % 10 = 3 OR l_orderkey % 41 = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(12,2)) AS price,
    CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS freight_value
  FROM lineitem),
m_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
    CASE WHEN o_orderkey % 4 < 2 THEN 'credit_card' WHEN o_orderkey % 4 = 2 THEN 'boleto' ELSE 'voucher' END AS payment_type,
    CAST(o_orderkey*7 % 15 AS INT) AS payment_installments, CAST(o_totalprice AS DECIMAL(12,2)) AS payment_value
  FROM orders),
m_reviews AS (
  SELECT o_orderkey * 2 + nth AS review_id, o_orderkey AS order_id,
    CAST(1 + (o_orderkey * 3 + nth * (1 + o_orderkey // 5)) % 5 AS INT) AS review_score
  FROM orders, (VALUES (0), (1)) AS v(nth)
  WHERE o_orderkey % 11 <> 0 AND (nth = 0 OR o_orderkey % 5 = 0)),
m_raw_reviews AS (
  SELECT l_orderkey*10+l_linenumber AS review_id, l_orderkey AS order_id, CAST(1 + l_partkey % 5 AS INT) AS review_score,
    CASE WHEN l_partkey % 23 <> 0 THEN l_shipdate END AS review_answer_timestamp
  FROM lineitem),
m_raw_geo AS (
  SELECT c_nationkey AS zip, c_custkey AS ord, CAST(c_acctbal AS DECIMAL(12,2)) AS lat, c_mktsegment AS city FROM customer)
"""


def hu(num: str, den: str, k: int) -> str:
    """round_half_up(num * 10^k / den) for integer-valued num, den; NULL when den is 0."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (f"(CASE WHEN {d} = 0 THEN NULL ELSE SIGN({n}) * SIGN({d}) * "
            f"((2 * ABS({n}) * CAST({10 ** k} AS HUGEINT) + ABS({d})) // (2 * ABS({d}))) END)")


def dec(q: str, s: int) -> str:
    """Integer q read as a decimal with s fraction digits (exact)."""
    unit = "1" if s == 0 else "0." + "0" * (s - 1) + "1"
    return f"(CAST(({q}) AS DECIMAL(38,0)) * CAST('{unit}' AS DECIMAL(38,{s})))"


def avg_sql(x: str, scale: int = 0) -> str:
    """MySQL AVG of an integer/decimal(·,scale) expression: exact, half up, scale + 4."""
    ints = f"SUM(CAST(({x}) * {10 ** scale} AS HUGEINT))"
    return dec(hu(ints, f"COUNT({x})", 4), scale + 4)


def div_sql(num: str, den: str, scale_in: int, scale_out: int) -> str:
    """num / den (both decimals with scale_in digits) half up at scale_out."""
    f = 10 ** scale_in
    return dec(hu(f"({num}) * {f}", f"({den}) * {f}", scale_out), scale_out)


def pub(x: str, digits: int) -> str:
    return f"CAST(ROUND({x}, {digits}) AS DOUBLE)"


def _with(body: str) -> str:
    return "WITH " + MAPPING.strip() + ",\n" + body.strip()


def _plain(body: str) -> str:
    return "WITH " + MAPPING.strip() + "\n" + body.strip()


# --------------------------------------------------------------------------- marts
# Money by month from one row per order; the month before is the next smaller one present.
_MONTHS = """
order_money AS (SELECT order_id, SUM(price) AS goods, SUM(freight_value) AS carriage FROM m_items GROUP BY order_id),
months AS (
  SELECT date_trunc('month', order_purchase_timestamp) AS month_start, COUNT(*) AS n, SUM(goods) AS goods, SUM(carriage) AS carriage
  FROM m_orders JOIN order_money USING (order_id) WHERE order_status = 'delivered' GROUP BY month_start),
numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY month_start) AS k FROM months),
paired AS (SELECT now.*, before.goods AS goods_before FROM numbered now LEFT JOIN numbered before ON before.k = now.k - 1)
"""


def _months_out(goods: str, before: str) -> str:
    return f"""
SELECT strftime(month_start, '%Y-%m') AS order_month, CAST(n AS BIGINT) AS orders,
  {pub(goods, 2)} AS product_revenue, {pub("carriage", 2)} AS freight_revenue, {pub(before, 2)} AS prev_month_revenue,
  {pub(div_sql(f"100 * ({goods} - {before})", before, 2, 6), 1)} AS mom_growth_pct
FROM paired
"""


MART_MONTHLY_REVENUE = _with(_MONTHS + _months_out("goods", "goods_before"))

_CATEGORY = f"""
cat AS (
  SELECT COALESCE(t.product_category_name_english, p.product_category_name, 'uncategorized') AS category,
    COUNT(DISTINCT oi.order_id) AS orders, SUM(oi.price) AS rev
  FROM m_items oi
  JOIN m_orders o ON o.order_id = oi.order_id AND o.order_status = 'delivered'
  JOIN m_products p ON p.product_id = oi.product_id
  LEFT JOIN m_translation t ON t.product_category_name = p.product_category_name
  GROUP BY 1),
shared AS (SELECT *, SUM(rev) OVER () AS total FROM cat)
"""

MART_TOP_CATEGORIES = _with(_CATEGORY + f"""
SELECT category, CAST(orders AS BIGINT) AS orders, {pub("rev", 2)} AS revenue,
  {pub(div_sql("100 * rev", "total", 2, 6), 2)} AS revenue_share_pct
FROM shared ORDER BY rev DESC, category LIMIT 15
""")

WIN_SHARE_OF_TOTAL = _with(_CATEGORY + f"""
SELECT category, CAST(orders AS BIGINT) AS orders, {pub("rev", 2)} AS revenue,
  {pub(div_sql("100 * rev", "total", 2, 6), 2)} AS revenue_share_pct
FROM shared
""")


# Names in any case are one; the least spelling of a group is shown.
TOP_CATEGORIES_COLLATED = _with(f"""
spelled AS (
  SELECT product_id, CASE product_id % 3 WHEN 0 THEN upper(product_category_name) WHEN 1 THEN lower(product_category_name)
                                         ELSE product_category_name END AS name FROM m_products),
words AS (SELECT lower(product_category_name) AS low, MIN(product_category_name_english) AS english FROM m_translation GROUP BY low),
labels AS (
  SELECT product_id, COALESCE(english, name, 'uncategorized') AS label FROM spelled LEFT JOIN words ON words.low = lower(name)),
sums AS (
  SELECT lower(label) AS low, MIN(label) AS category, COUNT(DISTINCT order_id) AS orders, SUM(price) AS rev
  FROM m_items JOIN labels USING (product_id) JOIN m_orders USING (order_id) WHERE order_status = 'delivered' GROUP BY 1),
whole AS (SELECT SUM(rev) AS total FROM sums)
SELECT category, CAST(orders AS BIGINT) AS orders, {pub("rev", 2)} AS revenue, {pub(div_sql("100 * rev", "total", 2, 6), 2)} AS revenue_share_pct
FROM sums, whole ORDER BY rev DESC, category LIMIT 15
""")


def _delivery_by_state(min_orders: int) -> str:
    return _plain(f"""
SELECT c.customer_state, CAST(COUNT(*) AS BIGINT) AS delivered_orders,
  {pub(avg_sql("date_diff('day', CAST(o.order_purchase_timestamp AS DATE), CAST(o.order_delivered_customer_date AS DATE))"), 1)} AS avg_delivery_days,
  {pub(avg_sql("date_diff('day', CAST(o.order_delivered_customer_date AS DATE), CAST(o.order_estimated_delivery_date AS DATE))"), 1)} AS avg_days_before_estimate,
  {pub("100 * " + avg_sql("CAST(o.order_delivered_customer_date > o.order_estimated_delivery_date AS INT)"), 2)} AS late_delivery_pct
FROM m_orders o JOIN m_customers c ON c.customer_id = o.customer_id
WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
GROUP BY c.customer_state
HAVING COUNT(*) >= {min_orders}
ORDER BY late_delivery_pct DESC
""")


MART_DELIVERY_BY_STATE = _delivery_by_state(100)
HAVING_MIN_VOLUME = _delivery_by_state(180)

# A person's months as whole numbers; the least is the cohort, and all of a cohort are there at offset 0.
_COHORTS = """
person_months AS (
  SELECT DISTINCT customer_unique_id AS person, year(order_purchase_timestamp) * 12 + month(order_purchase_timestamp) - 1 AS month_no
  FROM m_orders JOIN m_customers USING (customer_id) WHERE order_status = 'delivered'),
since AS (SELECT person, MIN(month_no) AS start_no FROM person_months GROUP BY person),
cohort_size AS (SELECT start_no, COUNT(*) AS size FROM since GROUP BY start_no),
seen AS (
  SELECT start_no, month_no - start_no AS later, COUNT(*) AS people
  FROM person_months JOIN since USING (person) GROUP BY start_no, later),
cohorts AS (
  SELECT printf('%04d-%02d-01', start_no // 12, start_no % 12 + 1) AS cohort_month, later, people, size
  FROM seen JOIN cohort_size USING (start_no))
"""

MART_COHORT_RETENTION = _with(_COHORTS + f"""
SELECT cohort_month, CAST(later AS BIGINT) AS month_offset, CAST(people AS BIGINT) AS active_customers,
  {pub(dec(hu("100 * people", "size", 4), 4), 2)} AS retention_pct
FROM cohorts WHERE later <= 6
""")

_PEOPLE = """
spent AS (SELECT order_id, SUM(price + freight_value) AS paid FROM m_items GROUP BY order_id),
people AS (
  SELECT customer_unique_id AS person, MAX(order_purchase_timestamp) AS latest, COUNT(*) AS times, SUM(paid) AS paid
  FROM m_orders JOIN spent USING (order_id) JOIN m_customers USING (customer_id)
  WHERE order_status = 'delivered' GROUP BY person)
"""


def _fifth(place: str) -> str:
    """Tile of five for a 1-based place among n: the first n % 5 tiles have one row more."""
    wide = "(n // 5 + 1)"
    return (f"CAST(CASE WHEN {place} <= (n % 5) * {wide} THEN ({place} - 1) // {wide} + 1"
            f" ELSE n % 5 + ({place} - (n % 5) * {wide} - 1) // greatest(n // 5, 1) + 1 END AS INT)")


_SCORES = _PEOPLE + f""",
places AS (
  SELECT *, COUNT(*) OVER () AS n,
    ROW_NUMBER() OVER (ORDER BY latest, person) AS by_time, ROW_NUMBER() OVER (ORDER BY times, person) AS by_times,
    ROW_NUMBER() OVER (ORDER BY paid, person) AS by_paid,
    date_diff('day', CAST(latest AS DATE), (SELECT CAST(MAX(order_purchase_timestamp) AS DATE) FROM m_orders)) AS days
  FROM people),
scores AS (SELECT *, {_fifth("by_time")} AS r, {_fifth("by_times")} AS f, {_fifth("by_paid")} AS m FROM places)
"""

MART_RFM_SEGMENTS = _with(_SCORES + f""",
named AS (
  SELECT *, CASE WHEN r IN (4, 5) AND f IN (4, 5) THEN 'champions' WHEN r IN (4, 5) AND f IN (1, 2) THEN 'promising_new'
                 WHEN r IN (1, 2) AND f IN (4, 5) THEN 'at_risk_loyal' WHEN r IN (1, 2) AND f IN (1, 2) THEN 'hibernating'
                 ELSE 'regular' END AS segment
  FROM scores)
SELECT segment, CAST(COUNT(*) AS BIGINT) AS customers, {pub(avg_sql("days"), 0)} AS avg_recency_days,
  {pub(avg_sql("times"), 2)} AS avg_frequency, {pub(avg_sql("paid", 4), 2)} AS avg_monetary
FROM named GROUP BY segment
""")

RFM_SCORES = _with(_SCORES + """
SELECT person AS customer_unique_id, CAST(days AS INT) AS recency_days, CAST(times AS BIGINT) AS frequency,
  CAST(paid AS DOUBLE) AS monetary, r AS r_score, f AS f_score, m AS m_score FROM scores
""")

WIN_NTILE = _with(_SCORES + """
SELECT person AS customer_unique_id, CAST(times AS BIGINT) AS frequency, f AS f_score FROM scores
""")

# Lines of a seller per order first; an order's reviews weigh once for each of its lines.
_SELLERS = f"""
lines AS (SELECT seller_id, order_id, COUNT(*) AS n, SUM(price) AS goods FROM m_items GROUP BY seller_id, order_id),
opinions AS (SELECT order_id, SUM(review_score) AS points, COUNT(review_score) AS votes FROM m_reviews GROUP BY order_id),
sold AS (
  SELECT seller_id, COUNT(*) AS orders, ROUND(SUM(goods), 2) AS revenue
  FROM lines WHERE order_id IN (SELECT order_id FROM m_orders WHERE order_status = 'delivered') GROUP BY seller_id),
judged AS (
  SELECT seller_id, ROUND({dec(hu("SUM(n * points)", "SUM(n * votes)", 4), 4)}, 2) AS mean_score
  FROM lines JOIN opinions USING (order_id) GROUP BY seller_id),
listed AS (
  SELECT seller_id, seller_state, orders, revenue, mean_score
  FROM sold JOIN m_sellers USING (seller_id) LEFT JOIN judged USING (seller_id) WHERE orders >= 10),
levels AS (SELECT revenue, ROW_NUMBER() OVER (ORDER BY revenue DESC) AS level FROM (SELECT DISTINCT revenue FROM listed) AS d)
"""

MART_SELLER_RANKING = _with(_SELLERS + """
SELECT seller_id, seller_state, CAST(orders AS BIGINT) AS orders, CAST(revenue AS DOUBLE) AS revenue,
  CAST(mean_score AS DOUBLE) AS avg_review_score, CAST(level AS BIGINT) AS revenue_rank
FROM listed JOIN levels USING (revenue) ORDER BY level, seller_id LIMIT 20
""")

WIN_DENSE_RANK = _with(_SELLERS + """
SELECT seller_id, CAST(revenue AS DOUBLE) AS revenue, CAST(level AS BIGINT) AS revenue_rank FROM listed JOIN levels USING (revenue)
""")

WIN_DENSE_RANK_HOT = _with("""
sized AS (SELECT order_id, COUNT(*) AS n_items FROM m_items GROUP BY order_id)
SELECT order_id, n_items, DENSE_RANK() OVER (ORDER BY n_items DESC) AS size_rank FROM sized
""")

JOIN_FANOUT_AVERAGE = _with(_SELLERS + """
SELECT seller_id, CAST(mean_score AS DOUBLE) AS avg_review_score FROM judged
""")

MART_PAYMENT_MIX = _with(f"""
g AS (
  SELECT payment_type, COUNT(*) AS payments,
    {avg_sql("payment_installments")} AS ai, {avg_sql("payment_value", 2)} AS av, SUM(payment_value) AS tv
  FROM m_payments GROUP BY payment_type),
t AS (SELECT *, SUM(payments) OVER () AS total FROM g)
SELECT payment_type, CAST(payments AS BIGINT) AS payments,
  {pub(dec(hu("100 * payments", "total", 4), 4), 2)} AS share_pct,
  {pub("ai", 2)} AS avg_installments, {pub("av", 2)} AS avg_payment_value, {pub("tv", 2)} AS total_value
FROM t ORDER BY total_value DESC
""")

# Labels as a table of ranges; installments below 1 belong to the second one.
MART_INSTALLMENT_BUCKETS = _with(f"""
spans(label, low, high) AS (VALUES ('2_to_3', -1000000, 0), ('1_single', 1, 1), ('2_to_3', 2, 3), ('4_to_6', 4, 6), ('7_to_12', 7, 12),
                                   ('13_plus', 13, 1000000))
SELECT label AS installment_bucket, CAST(COUNT(*) AS BIGINT) AS payments, {pub(avg_sql("payment_value", 2), 2)} AS avg_payment_value
FROM m_payments JOIN spans ON payment_installments BETWEEN low AND high
WHERE payment_type = 'credit_card' GROUP BY label
""")

_DELAYS = """
spans(label, low, high) AS (VALUES ('1_week_plus_early', -1000000, -7), ('2_early', -6, -1), ('3_on_time', 0, 0), ('4_late_1_to_3d', 1, 3),
                                   ('5_late_4_to_7d', 4, 7)),
arrived AS (
  SELECT order_id, CAST(order_delivered_customer_date AS DATE) - CAST(order_estimated_delivery_date AS DATE) AS late
  FROM m_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL),
labelled AS (
  SELECT order_id, late, COALESCE(label, '6_late_8d_plus') AS label FROM arrived LEFT JOIN spans ON late BETWEEN low AND high)
"""

MART_DELAY_VS_REVIEWS = _with(_DELAYS + f"""
SELECT label AS delivery_bucket, CAST(COUNT(*) AS BIGINT) AS orders, {pub(avg_sql("review_score"), 2)} AS avg_review_score,
  {pub("100 * " + avg_sql("CAST(review_score = 1 AS INT)"), 1)} AS pct_one_star
FROM m_reviews JOIN labelled USING (order_id) GROUP BY label
""")

CASE_BUCKET = _with(_DELAYS + """
SELECT order_id, CAST(late AS INTEGER) AS delay_days, label AS delivery_bucket FROM labelled
""")

_ORDERS_OF_PERSON = """
held AS (SELECT customer_unique_id, COUNT(*) AS n FROM m_customers JOIN m_orders USING (customer_id) GROUP BY customer_unique_id)
"""

MART_REPEAT_RATE = _with(_ORDERS_OF_PERSON + f""",
summed AS (SELECT COUNT(*) AS people, COUNT(*) FILTER (WHERE n > 1) AS again, MAX(n) AS most FROM held)
SELECT CAST(people AS BIGINT) AS total_customers, CAST(again AS BIGINT) AS repeat_customers,
  {pub(dec(hu("100 * again", "people", 4), 4), 2)} AS repeat_rate_pct, CAST(most AS BIGINT) AS max_orders_one_customer
FROM summed
""")

MART_ORDER_HISTOGRAM = _with(_ORDERS_OF_PERSON + """
SELECT CAST(n AS BIGINT) AS order_count, CAST(COUNT(*) AS BIGINT) AS customers FROM held GROUP BY n
""")

# freight has 4 decimals in the mapping (2 in the raw files): ratio keeps 4 + 4 digits, its mean 12
_RATIO_INT = hu("oi.freight_value * 10000", "oi.price * 100", 6)  # freight / price at scale 8, as an integer

MART_FREIGHT_BY_REGION = _plain(f"""
SELECT c.customer_state, CAST(COUNT(DISTINCT oi.order_id) AS BIGINT) AS orders,
  {pub(avg_sql("oi.freight_value", 4), 2)} AS avg_freight,
  {pub(dec(hu(f"SUM({_RATIO_INT})", f"COUNT({_RATIO_INT})", 4), 12) + " * 100", 1)} AS freight_pct_of_price,
  {pub("100 * " + avg_sql("CAST(s.seller_state = c.customer_state AS INT)"), 1)} AS same_state_shipment_pct
FROM m_items oi
JOIN m_orders o ON o.order_id = oi.order_id AND o.order_status = 'delivered'
JOIN m_customers c ON c.customer_id = o.customer_id
JOIN m_sellers s ON s.seller_id = oi.seller_id
GROUP BY c.customer_state
HAVING COUNT(DISTINCT oi.order_id) >= 100
ORDER BY avg_freight DESC
""")


ORACLES: dict[str, str] = {
    "mart_monthly_revenue": MART_MONTHLY_REVENUE,
    "mart_top_categories": MART_TOP_CATEGORIES,
    "mart_delivery_by_state": MART_DELIVERY_BY_STATE,
    "mart_cohort_retention": MART_COHORT_RETENTION,
    "mart_rfm_segments": MART_RFM_SEGMENTS,
    "mart_seller_ranking": MART_SELLER_RANKING,
    "mart_payment_mix": MART_PAYMENT_MIX,
    "mart_installment_buckets": MART_INSTALLMENT_BUCKETS,
    "mart_delay_vs_reviews": MART_DELAY_VS_REVIEWS,
    "mart_repeat_rate": MART_REPEAT_RATE,
    "mart_order_histogram": MART_ORDER_HISTOGRAM,
    "mart_freight_by_region": MART_FREIGHT_BY_REGION,
    "win_ntile": WIN_NTILE,
    "rfm_scores": RFM_SCORES,
    "win_dense_rank": WIN_DENSE_RANK,
    "win_dense_rank_hot": WIN_DENSE_RANK_HOT,
    "top_categories_collated": TOP_CATEGORIES_COLLATED,
    "win_share_of_total": WIN_SHARE_OF_TOTAL,
    "having_min_volume": HAVING_MIN_VOLUME,
    "join_fanout_average": JOIN_FANOUT_AVERAGE,
    "case_bucket": CASE_BUCKET,
}


# --------------------------------------------------------------------------- raw files (text)
def _messy(text: str, key: str) -> str:
    return (f"(CASE ({key}) % 4 WHEN 0 THEN chr(9) || ' ' || {text} || ' ' || chr(10) "
            f"WHEN 1 THEN ' ' || lower({text}) WHEN 2 THEN lower({text}) || '  ' ELSE {text} END)")


def _state(nk: str) -> str:
    return f"('N' || chr(CAST(65 + {nk} AS INT)))"


RAW = f"""
raw_customers AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS customer_id, CAST(o_custkey AS VARCHAR) AS customer_unique_id,
    CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
    {_messy("c_mktsegment", "o_orderkey")} AS customer_city,
    {_messy(_state("c_nationkey"), "o_orderkey + 1")} AS customer_state
  FROM orders JOIN customer ON o_custkey = c_custkey),
raw_sellers AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
    {_messy("s_name", "s_suppkey")} AS seller_city, {_messy(_state("s_nationkey"), "s_suppkey")} AS seller_state
  FROM supplier),
raw_orders AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
    CASE WHEN order_status = 'delivered' THEN ' Delivered' WHEN order_status = 'shipped' THEN 'SHIPPED '
         ELSE 'processing' END AS order_status,
    CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp,
    CASE WHEN order_id % 13 = 0 THEN 'not a date' WHEN order_id % 11 = 0 THEN NULL
         ELSE CAST(order_purchase_timestamp + CAST(order_id % 3 AS INT) * INTERVAL '1' DAY AS VARCHAR) END AS order_approved_at,
    CAST(NULL AS VARCHAR) AS order_delivered_carrier_date,
    CAST(order_delivered_customer_date AS VARCHAR) AS order_delivered_customer_date,
    CAST(order_estimated_delivery_date AS VARCHAR) AS order_estimated_delivery_date
  FROM m_orders),
raw_items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                                                         l_extendedprice, l_tax) AS VARCHAR) AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CAST(l_shipdate AS VARCHAR) AS shipping_limit_date,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
    CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS VARCHAR) AS freight_value
  FROM lineitem),
raw_payments AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, '1' AS payment_sequential,
    CASE WHEN o_orderkey % 4 < 2 THEN ' Credit_Card' WHEN o_orderkey % 4 = 2 THEN 'BOLETO ' ELSE 'voucher' END AS payment_type,
    CAST(o_orderkey * 7 % 15 AS VARCHAR) AS payment_installments,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS payment_value
  FROM orders),
raw_reviews AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS review_id, CAST(l_orderkey AS VARCHAR) AS order_id,
    CAST(1 + l_partkey % 5 AS VARCHAR) AS review_score,
    CASE WHEN l_partkey % 3 = 0 THEN 'NA' ELSE 'item ' || CAST(l_linenumber AS VARCHAR) END AS review_comment_title,
    CASE WHEN l_partkey % 2 = 0 THEN 'said "ok"' || chr(10) || 'second line, with comma' END AS review_comment_message,
    CAST(l_shipdate AS VARCHAR) AS review_creation_date,
    CASE WHEN l_partkey % 23 <> 0 THEN CAST(l_shipdate + CAST(l_partkey % 5 AS INT) * INTERVAL '1' DAY AS VARCHAR) END
      AS review_answer_timestamp
  FROM lineitem),
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS product_category_name,
    CAST(length(p_name) AS VARCHAR) AS product_name_lenght, CAST(p_size * 7 AS VARCHAR) AS product_description_lenght,
    CAST(p_size % 5 AS VARCHAR) AS product_photos_qty,
    CAST(CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS VARCHAR) AS product_weight_g,
    CAST(p_size AS VARCHAR) AS product_length_cm, CAST(p_size % 7 + 1 AS VARCHAR) AS product_height_cm,
    CAST(p_size % 11 + 2 AS VARCHAR) AS product_width_cm
  FROM part),
raw_translation AS (
  SELECT p_type AS product_category_name, lower(p_type) || '_' || CAST(p_partkey AS VARCHAR) AS product_category_name_english,
    p_partkey AS file_order
  FROM part WHERE p_type <> 'PROMO')
"""


def na(x: str) -> str:
    toks = ", ".join(f"'{t}'" for t in MISSING)
    return f"(CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END)"


# Characters Python's str.strip() removes (Unicode whitespace plus \x1c-\x1f).
_WS_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198,
             8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
_WS = " || ".join(f"chr({c})" for c in _WS_CODES)


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def ts(x: str) -> str:
    return f"try_strptime({x}, '%Y-%m-%d %H:%M:%S')"


def _raw(body: str) -> str:
    return "WITH " + MAPPING.strip() + ",\n" + RAW.strip() + ",\n" + body.strip()


def _raw_plain(body: str) -> str:
    return "WITH " + MAPPING.strip() + ",\n" + RAW.strip() + "\n" + body.strip()


CLEAN_TEXT = _raw_plain(f"SELECT customer_id, lower({strip('customer_city')}) AS customer_city FROM raw_customers")
CLEAN_STATE = _raw_plain(f"SELECT customer_id, upper({strip(na('customer_state'))}) AS customer_state FROM raw_customers")
CLEAN_TO_DATETIME = _raw_plain(f"SELECT order_id, {ts('order_approved_at')} AS order_approved_at FROM raw_orders")
CLEAN_RENAME = _raw_plain("""
SELECT product_id, TRY_CAST(product_name_lenght AS DOUBLE) AS product_name_length,
  TRY_CAST(product_description_lenght AS DOUBLE) AS product_description_length FROM raw_products""")

T_CUSTOMERS = _raw_plain(f"""
SELECT customer_id, customer_unique_id, TRY_CAST(customer_zip_code_prefix AS INT) AS customer_zip_code_prefix,
  lower({strip('customer_city')}) AS customer_city, upper({strip(na('customer_state'))}) AS customer_state
FROM raw_customers""")

T_SELLERS = _raw_plain(f"""
SELECT seller_id, TRY_CAST(seller_zip_code_prefix AS INT) AS seller_zip_code_prefix,
  lower({strip('seller_city')}) AS seller_city, upper({strip(na('seller_state'))}) AS seller_state
FROM raw_sellers""")

T_ORDERS = _raw_plain(f"""
SELECT order_id, customer_id, lower({strip('order_status')}) AS order_status,
  {ts('order_purchase_timestamp')} AS order_purchase_timestamp, {ts('order_approved_at')} AS order_approved_at,
  {ts('order_delivered_carrier_date')} AS order_delivered_carrier_date,
  {ts('order_delivered_customer_date')} AS order_delivered_customer_date,
  {ts('order_estimated_delivery_date')} AS order_estimated_delivery_date
FROM raw_orders""")

T_ORDER_ITEMS = _raw_plain(f"""
SELECT order_id, TRY_CAST(order_item_id AS INT) AS order_item_id, product_id, seller_id,
  {ts('shipping_limit_date')} AS shipping_limit_date,
  CAST(TRY_CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
  CAST(TRY_CAST(freight_value AS DECIMAL(10,2)) AS DOUBLE) AS freight_value
FROM raw_items""")

T_PAYMENTS = _raw_plain(f"""
SELECT order_id, TRY_CAST(payment_sequential AS INT) AS payment_sequential,
  lower({strip('payment_type')}) AS payment_type, TRY_CAST(payment_installments AS INT) AS payment_installments,
  CAST(TRY_CAST(payment_value AS DECIMAL(10,2)) AS DOUBLE) AS payment_value
FROM raw_payments""")

T_PRODUCTS = _raw_plain("""
SELECT product_id, product_category_name,
  TRY_CAST(product_name_lenght AS DOUBLE) AS product_name_length,
  TRY_CAST(product_description_lenght AS DOUBLE) AS product_description_length,
  TRY_CAST(product_photos_qty AS DOUBLE) AS product_photos_qty, TRY_CAST(product_weight_g AS DOUBLE) AS product_weight_g,
  TRY_CAST(product_length_cm AS DOUBLE) AS product_length_cm, TRY_CAST(product_height_cm AS DOUBLE) AS product_height_cm,
  TRY_CAST(product_width_cm AS DOUBLE) AS product_width_cm
FROM raw_products""")

T_ORDER_REVIEWS = _raw(f"""
typed AS (
  SELECT review_id, order_id, TRY_CAST(review_score AS INT) AS review_score,
    {na('review_comment_title')} AS review_comment_title, review_comment_message,
    {ts('review_creation_date')} AS review_creation_date, {ts('review_answer_timestamp')} AS review_answer_timestamp
  FROM raw_reviews),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id, order_id
    ORDER BY (review_answer_timestamp IS NULL) DESC, review_answer_timestamp DESC, review_score DESC NULLS LAST,
             review_comment_title DESC NULLS LAST, review_comment_message DESC NULLS LAST,
             review_creation_date DESC NULLS LAST) AS rn
  FROM typed)
SELECT review_id, order_id, review_score, review_comment_title, review_comment_message, review_creation_date,
  review_answer_timestamp
FROM ranked WHERE rn = 1""")

DEDUP_FULL_ROW = _plain("SELECT DISTINCT * FROM m_raw_reviews")

DEDUP_KEEP_LATEST = _with("""
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY review_id, order_id
    ORDER BY (review_answer_timestamp IS NULL) DESC, review_answer_timestamp DESC, review_score DESC) AS rn
  FROM m_raw_reviews)
SELECT review_id, order_id, review_score, review_answer_timestamp FROM ranked WHERE rn = 1""")

DEDUP_KEEP_FIRST = _raw_plain("""
SELECT product_category_name, arg_min(product_category_name_english, file_order) AS product_category_name_english
FROM raw_translation GROUP BY product_category_name""")

GEO_COLLAPSE = _plain(f"""
SELECT zip, CAST({avg_sql("lat", 8)} AS DOUBLE) AS lat,
  arg_min(city, ord) FILTER (WHERE city IS NOT NULL) AS city
FROM m_raw_geo WHERE zip IS NOT NULL GROUP BY zip""")

SRC_CSV_SCAN = _raw_plain("""
SELECT review_id, order_id, review_comment_title, review_comment_message FROM raw_reviews""")

SRC_NA_TOKENS = _raw_plain(f"""
SELECT review_id, order_id, {na('review_comment_title')} AS review_comment_title, review_comment_message
FROM raw_reviews""")

SRC_HEADER_CHECK = T_PAYMENTS

CONFORM_TYPES = _raw_plain("""
SELECT order_id, TRY_CAST(order_item_id AS INT) AS order_item_id, product_id, seller_id,
  shipping_limit_date, CAST(TRY_CAST(price AS DECIMAL(10,2)) AS DOUBLE) AS price,
  CAST(TRY_CAST(freight_value AS DECIMAL(10,2)) AS DOUBLE) AS freight_value
FROM raw_items""")

_TABLE_COUNTS = """
SELECT 'geolocation' AS "table", (SELECT COUNT(DISTINCT c_nationkey) FROM customer) AS n
UNION ALL SELECT 'customers', (SELECT COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey)
UNION ALL SELECT 'sellers', (SELECT COUNT(*) FROM supplier)
UNION ALL SELECT 'product_category_translation', (SELECT COUNT(DISTINCT p_type) FROM part WHERE p_type <> 'PROMO')
UNION ALL SELECT 'products', (SELECT COUNT(*) FROM part)
UNION ALL SELECT 'orders', (SELECT COUNT(*) FROM orders)
UNION ALL SELECT 'order_items', (SELECT COUNT(*) FROM lineitem)
UNION ALL SELECT 'order_payments', (SELECT COUNT(*) FROM orders)
UNION ALL SELECT 'order_reviews', (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey * 10 + l_linenumber, l_orderkey FROM lineitem))
"""

RECONCILE_COUNTS = f"""
SELECT "table", CAST(n AS BIGINT) AS expected, CAST(n AS BIGINT) AS loaded, TRUE AS ok FROM ({_TABLE_COUNTS}) t"""

SINK_OVERWRITE_IDEMPOTENT = f"""
SELECT "table", CAST(n AS BIGINT) AS rows, TRUE AS identical FROM ({_TABLE_COUNTS}) t"""

# Records of each raw file: more than published where cleaning removes repeated keys.
_RAW_COUNTS = f"""
SELECT "table", n AS published, CASE "table" WHEN 'geolocation' THEN (SELECT COUNT(*) FROM customer)
  WHEN 'product_category_translation' THEN (SELECT COUNT(*) FROM part WHERE p_type <> 'PROMO')
  WHEN 'order_reviews' THEN (SELECT COUNT(*) FROM lineitem) ELSE n END AS raw
FROM ({_TABLE_COUNTS}) t"""

PIPELINE_ROW_COUNTS = f"""
SELECT "table", CAST(raw AS BIGINT) AS raw_rows, CAST(published AS BIGINT) AS published_rows,
  CAST(raw - published AS BIGINT) AS dropped_rows FROM ({_RAW_COUNTS}) c"""

# Columns of the nine published tables.
SINK_EMPTY_TABLE = f"""
SELECT t."table", CAST(c.columns AS BIGINT) AS columns, TRUE AS as_declared, CAST(CASE WHEN t."table" = 'order_reviews' THEN 0 ELSE t.n END AS BIGINT) AS rows
FROM ({_TABLE_COUNTS}) t JOIN (VALUES ('geolocation', 5), ('customers', 5), ('sellers', 4), ('product_category_translation', 2), ('products', 9),
  ('orders', 8), ('order_items', 7), ('order_payments', 5), ('order_reviews', 7)) c("table", columns) ON t."table" = c."table"
"""

# The nine tables, parents first, and how many references each has.
LOAD_ORDER = f"""
SELECT CAST(o.position AS BIGINT) AS position, t."table", TRUE AS after_its_references, CAST(o.refs AS BIGINT) AS "references", CAST(t.n AS BIGINT) AS rows
FROM ({_TABLE_COUNTS}) t JOIN (VALUES (0, 'geolocation', 0), (1, 'customers', 0), (2, 'sellers', 0), (3, 'product_category_translation', 0), (4, 'products', 0),
  (5, 'orders', 1), (6, 'order_items', 3), (7, 'order_payments', 1), (8, 'order_reviews', 1)) o(position, "table", refs) ON t."table" = o."table"
"""

SRC_PRESENCE = f"""
SELECT CASE "table" WHEN 'product_category_translation' THEN 'product_category_name_translation.csv' ELSE "table" || '_dataset.csv' END
  AS file_name, TRUE AS present, TRUE AS header_ok, CAST(raw AS BIGINT) AS rows FROM ({_RAW_COUNTS}) c"""

SRC_REJECTS = """
SELECT 'order_items' AS "table", "column", CAST(COALESCE(n, 0) AS BIGINT) AS rejects FROM (
  SELECT 'order_item_id' AS "column", COUNT(*) FILTER (WHERE l_orderkey % 31 = 0) AS n FROM lineitem
  UNION ALL SELECT 'price', COUNT(*) FILTER (WHERE l_orderkey % 19 = 0) FROM lineitem
  UNION ALL SELECT 'freight_value', COUNT(*) FILTER (WHERE l_orderkey % 23 = 0 AND l_orderkey % 7 <> 0) FROM lineitem
  UNION ALL SELECT '*', COUNT(*) FILTER (WHERE l_orderkey % 37 = 0) FROM lineitem) r"""

_BAD_ITEMS = (("order_item_id", "not int", "'first'", "l_orderkey % 31 = 0"),
              ("price", "not decimal(10,2)", "'EUR ' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)", "l_orderkey % 19 = 0"),
              ("freight_value", "not decimal(10,2)", "'1e12'", "l_orderkey % 23 = 0 AND l_orderkey % 7 <> 0"),
              ("*", "surplus fields", "CAST(NULL AS VARCHAR)", "l_orderkey % 37 = 0"))
SRC_QUARANTINE = " UNION ALL ".join(f"""
SELECT 'order_items' AS "table", '{column}' AS "column", '{reason}' AS reason, {value} AS value, CAST(l_orderkey AS VARCHAR) AS order_id,
  CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id, TRUE AS placed
FROM lineitem WHERE {condition}""" for column, reason, value, condition in _BAD_ITEMS)

_LAT, _LNG = (f"CAST(c_acctbal / {d} AS DECIMAL(12,6))" for d in (100, -50))
T_GEOLOCATION = f"""
WITH raw AS (
  SELECT c_nationkey AS zip, c_custkey AS place, {_LAT} AS lat, {_LNG} AS lng,
    CASE WHEN c_custkey % 5 <> 0 THEN lower({strip(_messy("c_mktsegment", "c_custkey"))}) END AS city,
    CASE WHEN c_custkey % 7 <> 0 THEN upper({strip(na(_messy(_state("c_nationkey"), "c_custkey")))}) END AS state
  FROM customer)
SELECT CAST(zip AS INT) AS geolocation_zip_code_prefix, CAST({avg_sql("lat", 8)} AS DOUBLE) AS geolocation_lat,
  CAST({avg_sql("lng", 8)} AS DOUBLE) AS geolocation_lng, arg_min(city, place) FILTER (WHERE city IS NOT NULL) AS geolocation_city,
  arg_min(state, place) FILTER (WHERE state IS NOT NULL) AS geolocation_state
FROM raw GROUP BY zip"""

PIPELINE_END_TO_END = _raw(f"""
order_goods AS (
  SELECT order_id, SUM(CAST(price AS DECIMAL(10,2))) AS goods, SUM(CAST(freight_value AS DECIMAL(10,2))) AS carriage
  FROM raw_items GROUP BY order_id),
months AS (
  SELECT date_trunc('month', {ts('order_purchase_timestamp')}) AS month_start, COUNT(*) AS n, SUM(goods) AS goods, SUM(carriage) AS carriage
  FROM raw_orders JOIN order_goods USING (order_id) WHERE lower({strip('order_status')}) = 'delivered' GROUP BY month_start),
numbered AS (SELECT *, ROW_NUMBER() OVER (ORDER BY month_start) AS k FROM months),
paired AS (SELECT now.*, before.goods AS goods_before FROM numbered now LEFT JOIN numbered before ON before.k = now.k - 1)
""" + _months_out("goods", "goods_before"))

DQ_UNIQUE = _plain("""
SELECT order_id, order_item_id, CAST(COUNT(*) AS BIGINT) AS n FROM m_items
GROUP BY order_id, order_item_id HAVING COUNT(*) > 1""")

DQ_FOREIGN_KEY = _plain("""
SELECT p.product_id, p.product_category_name FROM m_products p
WHERE p.product_category_name IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM m_translation t WHERE t.product_category_name = p.product_category_name)""")

DQ_NOT_NULL = _plain("""
SELECT 'order_id' AS "column", CAST(COUNT(*) - COUNT(order_id) AS BIGINT) AS nulls FROM m_orders
UNION ALL SELECT 'customer_id', COUNT(*) - COUNT(customer_id) FROM m_orders
UNION ALL SELECT 'order_status', COUNT(*) - COUNT(order_status) FROM m_orders
UNION ALL SELECT 'order_purchase_timestamp', COUNT(*) - COUNT(order_purchase_timestamp) FROM m_orders
UNION ALL SELECT 'order_delivered_customer_date', COUNT(*) - COUNT(order_delivered_customer_date) FROM m_orders
UNION ALL SELECT 'order_estimated_delivery_date', COUNT(*) - COUNT(order_estimated_delivery_date) FROM m_orders""")

DQ_DOMAIN = _with("""
dom AS (
SELECT 'customers' AS "table", 'customer_id' AS "column", 'width<=32' AS "check",
  CAST(SUM(CAST(length(CAST(customer_id AS VARCHAR)) > 32 AS INT)) AS BIGINT) AS violations FROM m_customers
UNION ALL SELECT 'customers', 'customer_unique_id', 'width<=32',
  SUM(CAST(length(CAST(customer_unique_id AS VARCHAR)) > 32 AS INT)) FROM m_customers
UNION ALL SELECT 'customers', 'customer_state', 'width<=2',
  SUM(CAST(length(customer_state) > 2 AS INT)) FROM m_customers
UNION ALL SELECT 'order_items', 'order_id', 'width<=32', SUM(CAST(length(CAST(order_id AS VARCHAR)) > 32 AS INT)) FROM m_items
UNION ALL SELECT 'order_items', 'product_id', 'width<=32', SUM(CAST(length(CAST(product_id AS VARCHAR)) > 32 AS INT)) FROM m_items
UNION ALL SELECT 'order_items', 'seller_id', 'width<=32', SUM(CAST(length(CAST(seller_id AS VARCHAR)) > 32 AS INT)) FROM m_items
UNION ALL SELECT 'order_items', 'price', 'decimal(10,2)',
  SUM(CAST(price IS NOT NULL AND TRY_CAST(price AS DECIMAL(10,2)) IS NULL AS INT)) FROM m_items
UNION ALL SELECT 'order_items', 'freight_value', 'decimal(10,2)',
  SUM(CAST(freight_value IS NOT NULL AND TRY_CAST(freight_value AS DECIMAL(10,2)) IS NULL AS INT)) FROM m_items)
SELECT "table", "column", "check", CAST(violations AS BIGINT) AS violations FROM dom""")

ORACLES.update({
    "clean_text": CLEAN_TEXT, "clean_state": CLEAN_STATE, "clean_to_datetime": CLEAN_TO_DATETIME,
    "clean_rename": CLEAN_RENAME, "t_customers": T_CUSTOMERS, "t_sellers": T_SELLERS, "t_orders": T_ORDERS,
    "t_order_items": T_ORDER_ITEMS, "t_payments": T_PAYMENTS, "t_products": T_PRODUCTS,
    "t_order_reviews": T_ORDER_REVIEWS, "dedup_full_row": DEDUP_FULL_ROW, "dedup_keep_latest": DEDUP_KEEP_LATEST,
    "dedup_keep_first": DEDUP_KEEP_FIRST, "geo_collapse": GEO_COLLAPSE, "src_csv_scan": SRC_CSV_SCAN,
    "src_na_tokens": SRC_NA_TOKENS, "src_header_check": SRC_HEADER_CHECK, "conform_types": CONFORM_TYPES,
    "reconcile_counts": RECONCILE_COUNTS, "sink_overwrite_idempotent": SINK_OVERWRITE_IDEMPOTENT,
    "pipeline_row_counts": PIPELINE_ROW_COUNTS, "src_presence": SRC_PRESENCE, "src_rejects": SRC_REJECTS,
    "src_quarantine": SRC_QUARANTINE, "sink_empty_table": SINK_EMPTY_TABLE, "load_order": LOAD_ORDER,
    "src_mixed_headers": T_PAYMENTS, "t_geolocation": T_GEOLOCATION,
    "pipeline_end_to_end": PIPELINE_END_TO_END, "dq_unique": DQ_UNIQUE, "dq_foreign_key": DQ_FOREIGN_KEY,
    "dq_not_null": DQ_NOT_NULL, "dq_domain": DQ_DOMAIN,
})


# --------------------------------------------------------------------------- single primitives
WIN_LAG = _with("""
m AS (SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month, COUNT(*) AS orders FROM m_orders GROUP BY 1)
SELECT order_month, CAST(orders AS BIGINT) AS orders,
  CAST(LAG(orders) OVER (ORDER BY order_month) AS BIGINT) AS prev_orders FROM m""")

WIN_FIRST_VALUE = _with(_COHORTS + """
SELECT cohort_month, CAST(later AS BIGINT) AS month_offset, CAST(people AS BIGINT) AS active_customers, CAST(size AS BIGINT) AS cohort_size
FROM cohorts""")

FILTER_EQUALITY = _plain("SELECT order_id, order_purchase_timestamp FROM m_orders WHERE order_status = 'delivered'")

SHARE_TRUE = _plain(f"""
SELECT c.customer_state,
  CAST({avg_sql("CAST(o.order_delivered_customer_date > o.order_estimated_delivery_date AS INT)")} AS DOUBLE) AS late_share
FROM m_orders o JOIN m_customers c ON c.customer_id = o.customer_id
WHERE o.order_status = 'delivered' AND o.order_delivered_customer_date IS NOT NULL
GROUP BY c.customer_state""")

AGG_COUNT_DISTINCT = _plain("SELECT seller_id, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS orders FROM m_items GROUP BY seller_id")

SCALAR_SUBQUERY_RECENCY = _with(_SCORES + """
SELECT person AS customer_unique_id, CAST(days AS INT) AS recency_days FROM scores""")

DATEDIFF_AVERAGE = _plain(f"""
SELECT strftime(order_purchase_timestamp, '%Y-%m') AS order_month,
  {pub(avg_sql("date_diff('day', CAST(order_purchase_timestamp AS DATE), CAST(order_delivered_customer_date AS DATE))"), 1)}
    AS avg_delivery_days
FROM m_orders WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
GROUP BY 1""")

MEAN_OF_RATIOS = _plain(f"""
SELECT s.seller_state,
  {pub(dec(hu(f"SUM({_RATIO_INT})", f"COUNT({_RATIO_INT})", 4), 12) + " * 100", 1)} AS freight_pct_of_price
FROM m_items oi JOIN m_sellers s ON s.seller_id = oi.seller_id
GROUP BY s.seller_state""")

TOPK = _plain("""
SELECT product_id, CAST(SUM(price) AS DOUBLE) AS revenue FROM m_items
GROUP BY product_id ORDER BY SUM(price) DESC, product_id LIMIT 10""")

MONTH_LABEL = _plain("SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS order_month FROM m_orders")
MONTH_FLOOR = _plain("SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m-01') AS month_start FROM m_orders")
MONTH_OFFSET = _plain("""
SELECT order_id, CAST(date_diff('month', date_trunc('month', order_purchase_timestamp),
                                 date_trunc('month', order_estimated_delivery_date)) AS BIGINT) AS month_offset
FROM m_orders WHERE order_estimated_delivery_date IS NOT NULL""")

SAFE_GROWTH_PCT = _with(_MONTHS + f"""
SELECT strftime(month_start, '%Y-%m') AS order_month, {pub(div_sql("100 * (goods - goods_before)", "goods_before", 2, 6), 1)} AS growth_pct
FROM paired""")

JOIN_LEFT_DIMENSION = _plain("""
SELECT p.product_id, COALESCE(t.product_category_name_english, p.product_category_name, 'uncategorized') AS category
FROM m_products p LEFT JOIN m_translation t ON t.product_category_name = p.product_category_name""")

ORACLES.update({
    "win_lag": WIN_LAG, "win_first_value": WIN_FIRST_VALUE, "filter_equality": FILTER_EQUALITY,
    "share_true": SHARE_TRUE, "agg_count_distinct": AGG_COUNT_DISTINCT,
    "scalar_subquery_recency": SCALAR_SUBQUERY_RECENCY, "datediff_average": DATEDIFF_AVERAGE,
    "mean_of_ratios": MEAN_OF_RATIOS, "topk": TOPK, "month_label": MONTH_LABEL, "month_floor": MONTH_FLOOR,
    "month_offset": MONTH_OFFSET, "safe_growth_pct": SAFE_GROWTH_PCT, "join_left_dimension": JOIN_LEFT_DIMENSION,
})

from decimal import Decimal

from shopmarts.operators import quality
from shopmarts.sources import csv_source
from shopmarts.sources.contracts import BY_TABLE


def _by_check(df):
    return {(r["column"], r["check"]): r["violations"] for r in df.collect()}


def test_domain_checks_count_each_violation(spark):
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", Decimal("12345678.90"), Decimal("1.00")),
         ("o2", 1, "p", "s", Decimal("123456789.00"), Decimal("1.00")),  # 9 integer digits > decimal(10,2)
         ("o" * 33, 1, "p", "s", Decimal("1.00"), None)],                 # id longer than 32
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "price decimal(12,2), freight_value decimal(12,2)")
    got = _by_check(quality.domain_counts(items, BY_TABLE["order_items"]))
    assert got[("price", "decimal(10,2)")] == 1
    assert got[("freight_value", "decimal(10,2)")] == 0  # NULL is not a domain violation
    assert got[("order_id", "width<=32")] == 1


def test_tinyint_and_not_null_checks(spark):
    reviews = spark.createDataFrame([("r1", "o1", 5), ("r2", "o2", 300), ("r3", None, -129)],
                                    "review_id string, order_id string, review_score int")
    rows = quality.column_checks(reviews, BY_TABLE["order_reviews"]).collect()
    got = {(r["columns"], r["check"]): r["violations"] for r in rows}
    assert got[("review_score", "tinyint")] == 2
    assert got[("order_id", "not_null")] == 1


def test_reject_counts(spark):
    raw = spark.createDataFrame([("o1", "1", "credit_card", "2", "10.50"), ("o2", "x", "boleto", "", "abc"),
                                 ("o3", None, "voucher", "1", None)],
                                "order_id string, payment_sequential string, payment_type string, "
                                "payment_installments string, payment_value string")
    got = {r["column"]: r["rejects"] for r in csv_source.rejects_report(raw, BY_TABLE["order_payments"]).collect()}
    # text that fails the cast counts; NULL stays NULL and is not a reject
    assert got["payment_sequential"] == 1 and got["payment_value"] == 1 and got["payment_installments"] == 1


def test_key_reference_report_matches_joins(spark):
    """One aggregate per parent key gives the same counts as a key aggregate plus one anti join per
    reference; duplicate parents, NULL references and a hot key included."""
    from pyspark.sql import functions as F

    from shopmarts.sources.contracts import LOAD_ORDER

    items = [("o1", i) for i in range(20)] + [("o2", 1), ("o99", 1), ("o99", 2), (None, 3)] + \
            [(f"o{k}", 1) for k in range(3, 30)] + [("o1", 99)]  # o1 holds a third of the items
    t = {
        "customers": spark.createDataFrame([("c1", "u1"), ("c2", "u2"), ("c2", "u3")],
                                           "customer_id string, customer_unique_id string"),
        "orders": spark.createDataFrame([("o1", "c1"), ("o1", "c1"), ("o2", "c7"), ("o3", None)] +
                                        [(f"o{k}", "c2") for k in range(4, 30)], "order_id string, customer_id string"),
        "order_items": spark.createDataFrame(items, "order_id string, order_item_id int"),
        "order_payments": spark.createDataFrame([("o2", 1), ("o10x", 1)], "order_id string, payment_sequential int"),
        "order_reviews": spark.createDataFrame([("r1", "o1"), ("r2", "o77"), ("r3", "o77")],
                                               "review_id string, order_id string"),
    }
    got = {(r.table, r.check): r.violations for r in quality.quality_report(t, with_column_checks=False).collect()}
    expected = {}
    for name in LOAD_ORDER:
        if name not in t:
            continue
        c = BY_TABLE[name]
        expected[(name, "unique")] = quality.duplicate_keys(t[name], c.key).agg(F.sum("n")).first()[0] or 0
        for cols, parent, pcols in c.foreign_keys:
            if parent in t:
                expected[(name, f"foreign_key->{parent}")] = quality.orphans(t[name], cols, t[parent], pcols).count()
    assert got == expected
    assert got[("orders", "unique")] == 2 and got[("customers", "unique")] == 2
    assert got[("orders", "foreign_key->customers")] == 1 and got[("order_items", "foreign_key->orders")] == 2
    assert got[("order_reviews", "foreign_key->orders")] == 2 and got[("order_payments", "foreign_key->orders")] == 1

"""Declared contracts of the nine raw files and the nine published tables.

A contract holds the raw header (checked as a set; order is free), the published schema (names
after the rename step, types of the warehouse), the key, the NOT NULL columns, text widths, decimal
and small-integer domains, and foreign keys. Files are read as text and cast by name, so a file
whose columns come in another order still lands under the right names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()
TS = T.TimestampNTZType()
MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class FileContract:
    table: str
    file_stem: str                      # file name without the optional vendor prefix
    columns: tuple[str, ...]            # raw header, as a set
    schema: T.StructType                # published table
    key: tuple[str, ...]
    not_null: tuple[str, ...]
    widths: dict[str, int] = field(default_factory=dict)     # max text length
    tinyint: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()
    renames: dict[str, str] = field(default_factory=dict)    # raw name -> published name
    multiline: bool = False              # free text with quoted newlines
    bucket_by: str | None = None         # published in buckets of this column, ...
    cluster_by: str | None = None        # ... each ordered by this one (default: bucket_by)

    def file_name(self, prefix: str = "") -> str:
        return self.file_stem if self.table == "product_category_translation" else prefix + self.file_stem


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw headers of the nine files (the source contract), file stems, widths and keys.
CONTRACTS: tuple[FileContract, ...] = (
    FileContract(
        "geolocation", "geolocation_dataset.csv",
        ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state"),
        _st(("geolocation_zip_code_prefix", I), ("geolocation_lat", D), ("geolocation_lng", D),
            ("geolocation_city", S), ("geolocation_state", S)),
        key=("geolocation_zip_code_prefix",),
        not_null=("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        widths={"geolocation_city": 64, "geolocation_state": 2}),
    FileContract(
        "customers", "customers_dataset.csv",
        ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        _st(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code_prefix", I),
            ("customer_city", S), ("customer_state", S)),
        key=("customer_id",), not_null=("customer_id", "customer_unique_id", "customer_zip_code_prefix"),
        widths={"customer_id": 32, "customer_unique_id": 32, "customer_city": 64, "customer_state": 2}),
    FileContract(
        "sellers", "sellers_dataset.csv",
        ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        _st(("seller_id", S), ("seller_zip_code_prefix", I), ("seller_city", S), ("seller_state", S)),
        key=("seller_id",), not_null=("seller_id", "seller_zip_code_prefix"),
        widths={"seller_id": 32, "seller_city": 64, "seller_state": 2}),
    FileContract(
        "product_category_translation", "product_category_name_translation.csv",
        ("product_category_name", "product_category_name_english"),
        _st(("product_category_name", S), ("product_category_name_english", S)),
        key=("product_category_name",), not_null=("product_category_name",),
        widths={"product_category_name": 64, "product_category_name_english": 64}),
    FileContract(
        "products", "products_dataset.csv",
        ("product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
         "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"),
        _st(("product_id", S), ("product_category_name", S), ("product_name_length", D),
            ("product_description_length", D), ("product_photos_qty", D), ("product_weight_g", D),
            ("product_length_cm", D), ("product_height_cm", D), ("product_width_cm", D)),
        key=("product_id",), not_null=("product_id",),
        widths={"product_id": 32, "product_category_name": 64},
        renames={"product_name_lenght": "product_name_length",
                 "product_description_lenght": "product_description_length"}),
    FileContract(
        "orders", "orders_dataset.csv",
        ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
         "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date"),
        _st(("order_id", S), ("customer_id", S), ("order_status", S), ("order_purchase_timestamp", TS),
            ("order_approved_at", TS), ("order_delivered_carrier_date", TS),
            ("order_delivered_customer_date", TS), ("order_estimated_delivery_date", TS)),
        key=("order_id",), not_null=("order_id", "customer_id", "order_status", "order_purchase_timestamp"),
        widths={"order_id": 32, "customer_id": 32, "order_status": 20},
        foreign_keys=((("customer_id",), "customers", ("customer_id",)),),
        bucket_by="order_id", cluster_by="order_purchase_timestamp"),
    FileContract(
        "order_items", "order_items_dataset.csv",
        ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        _st(("order_id", S), ("order_item_id", I), ("product_id", S), ("seller_id", S),
            ("shipping_limit_date", TS), ("price", MONEY), ("freight_value", MONEY)),
        key=("order_id", "order_item_id"),
        not_null=("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        widths={"order_id": 32, "product_id": 32, "seller_id": 32},
        foreign_keys=((("order_id",), "orders", ("order_id",)), (("product_id",), "products", ("product_id",)),
                      (("seller_id",), "sellers", ("seller_id",))),
        bucket_by="order_id"),
    FileContract(
        "order_payments", "order_payments_dataset.csv",
        ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        _st(("order_id", S), ("payment_sequential", I), ("payment_type", S), ("payment_installments", I),
            ("payment_value", MONEY)),
        key=("order_id", "payment_sequential"),
        not_null=("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        widths={"order_id": 32, "payment_type": 20},
        foreign_keys=((("order_id",), "orders", ("order_id",)),), bucket_by="order_id"),
    FileContract(
        "order_reviews", "order_reviews_dataset.csv",
        ("review_id", "order_id", "review_score", "review_comment_title", "review_comment_message",
         "review_creation_date", "review_answer_timestamp"),
        _st(("review_id", S), ("order_id", S), ("review_score", I), ("review_comment_title", S),
            ("review_comment_message", S), ("review_creation_date", TS), ("review_answer_timestamp", TS)),
        key=("review_id", "order_id"), not_null=("review_id", "order_id", "review_score"),
        widths={"review_id": 32, "order_id": 32}, tinyint=("review_score",),
        foreign_keys=((("order_id",), "orders", ("order_id",)),), multiline=True, bucket_by="order_id"),
)

# Columns of this prefix travel with the rows through the cleaning steps and are summed where rows merge;
# the sink counts them in the write's own stage and leaves them out of the table.
BOOK = "_book_"
BOOK_ROWS = f"{BOOK}rows"             # raw records that the row stands for
BOOK_GONE = f"{BOOK}gone"             # 1 for a row that is counted but not published


def book_columns(columns) -> list[str]:
    return [c for c in columns if c.startswith(BOOK)]


BY_TABLE: dict[str, FileContract] = {c.table: c for c in CONTRACTS}

# Parents before children: the order the foreign-key checks and the report follow.
LOAD_ORDER = ("geolocation", "customers", "sellers", "product_category_translation", "products", "orders",
              "order_items", "order_payments", "order_reviews")

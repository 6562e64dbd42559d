"""Cleaning operators (C1-C20): one documented Spark transform per table and its building blocks.

Order-dependent pandas semantics are made explicit:
* "first" = smallest file ordinal (``_file_order`` from the source, or any orderable column);
* "keep last after sorting by answer time" = greatest (NULL-first flag, time, remaining columns),
  i.e. a NULL answer time wins by default exactly like the sort-then-keep-last it replaces (T3).

Dedup and collapse are aggregates (``max``/``min_by`` over structs), not windows: they combine
map-side, so a key that holds a third of all rows is reduced before the shuffle instead of being
sorted in one task. Book columns (``contracts.BOOK``) are summed over the rows that become one, so what
a step drops is known exactly, also where a stage runs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.functions.exprs import DEFAULT_TS_FORMAT, clean_code, clean_text, to_datetime
from shopmarts.sources.contracts import BOOK_GONE, BY_TABLE, book_columns

ORDINAL = "_file_order"
MEAN_SCALE = 8


# --------------------------------------------------------------------------- building blocks
def _book_sums(df: DataFrame) -> list:
    return [F.sum(c).alias(c) for c in book_columns(df.columns)]


def parse_datetimes(df: DataFrame, cols, fmt: str | None = DEFAULT_TS_FORMAT) -> DataFrame:
    """Text -> timestamp_ntz, unparsable -> NULL."""
    return df.withColumns({c: to_datetime(c, fmt) for c in cols})


def normalise_text(df: DataFrame, cols) -> DataFrame:
    """Strip + lower."""
    return df.withColumns({c: clean_text(c) for c in cols})


def normalise_code(df: DataFrame, cols) -> DataFrame:
    """Strip + upper."""
    return df.withColumns({c: clean_code(c) for c in cols})


def rename_columns(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """C5."""
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def drop_identical(df: DataFrame, ignore=(ORDINAL,)) -> DataFrame:
    """Drop rows identical in every column (NULL equals NULL); bookkeeping columns ignored."""
    cols = [c for c in df.columns if c not in ignore]
    return df.dropDuplicates(cols)


def keep_latest(df: DataFrame, keys, ts: str, nulls: str = "newest", ignore=(ORDINAL,)) -> DataFrame:
    """One row per key, the one with the latest ``ts``.

    ``nulls='newest'`` (default) is what sorting ascending with missing values last and keeping the
    last row does: a NULL time wins. ``nulls='oldest'`` is the documented "most recent answer".
    Ties on the time are broken by the remaining columns (greatest wins), so the result is total.
    """
    keys = list(keys)
    books = book_columns(df.columns)
    rest = [c for c in df.columns if c not in keys and c != ts and c not in ignore and c not in books]
    flag = F.col(ts).isNull() if nulls == "newest" else F.col(ts).isNotNull()
    best = F.max(F.struct(flag.alias("_flag"), F.col(ts).alias(ts), *[F.col(c) for c in rest])).alias("_best")
    out = df.groupBy(*keys).agg(best, *_book_sums(df))
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in [ts, *rest]], *books).select(
        *[c for c in df.columns if c not in ignore])


def keep_first(df: DataFrame, keys, order_col: str = ORDINAL, collation: str | None = None) -> DataFrame:
    """One row per key, the first in ``order_col`` order (file order by default).

    With a ``collation`` (e.g. 'UNICODE_CI_AI') text keys that it holds equal are one key; the first
    row's own spelling is kept.
    """
    keys = list(keys)
    books = book_columns(df.columns)
    kept = [c for c in df.columns if c != order_col and c not in books]
    groups = [F.collate(c, collation).alias(f"_k{i}") if collation else F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]
    first = F.min_by(F.struct(*[F.col(c) for c in kept]), F.col(order_col)).alias("_first")
    return df.groupBy(*groups).agg(first, *_book_sums(df)).select(*keys_first(keys, kept), *books)


def keys_first(keys, kept) -> list:
    return [F.col(f"_first.{c}").alias(c) for c in [*keys, *[c for c in kept if c not in keys]]]


def first_non_null(col: str, order_col: str) -> F.Column:
    """pandas ``first`` in a groupby: first non-NULL value in file order."""
    c = F.col(col)
    return F.min_by(c, F.when(c.isNotNull(), F.col(order_col)))


def collapse_by_key(df: DataFrame, key: str, means=(), firsts=(), order_col: str = ORDINAL) -> DataFrame:
    """One row per key: mean of ``means``, first non-NULL of ``firsts``; NULL keys dropped (T4). With book
    columns the NULL key stays as one row marked ``BOOK_GONE``, for its records to be counted.

    Means are taken over DECIMAL values of ``MEAN_SCALE`` digits and cast to double once, so they do
    not depend on how rows are partitioned (T5).
    """
    aggs = [F.avg(F.col(c).cast(f"decimal(28,{MEAN_SCALE})")).cast("double").alias(c) for c in means]
    aggs += [first_non_null(c, order_col).alias(c) for c in firsts]
    if not book_columns(df.columns):
        return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)
    return df.groupBy(key).agg(*aggs, *_book_sums(df)).withColumn(BOOK_GONE, F.col(key).isNull().cast("long"))


# --------------------------------------------------------------------------- one transform per table
def transform_customers(df: DataFrame) -> DataFrame:
    return normalise_code(normalise_text(df, ["customer_city"]), ["customer_state"])


def transform_sellers(df: DataFrame) -> DataFrame:
    return normalise_code(normalise_text(df, ["seller_city"]), ["seller_state"])


def transform_geolocation(df: DataFrame) -> DataFrame:
    df = normalise_code(normalise_text(df, ["geolocation_city"]), ["geolocation_state"])
    return collapse_by_key(df, "geolocation_zip_code_prefix", means=("geolocation_lat", "geolocation_lng"),
                           firsts=("geolocation_city", "geolocation_state"))


ORDER_TS = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")


def transform_orders(df: DataFrame, fmt: str | None = DEFAULT_TS_FORMAT) -> DataFrame:
    """All five times parsed; an order without a delivery time keeps NULL there."""
    return normalise_text(parse_datetimes(df, ORDER_TS, fmt), ["order_status"])


def transform_order_items(df: DataFrame, fmt: str | None = DEFAULT_TS_FORMAT) -> DataFrame:
    return parse_datetimes(df, ["shipping_limit_date"], fmt)


def transform_payments(df: DataFrame) -> DataFrame:
    return normalise_text(df, ["payment_type"])


def transform_reviews(df: DataFrame, nulls: str = "newest", fmt: str | None = DEFAULT_TS_FORMAT) -> DataFrame:
    """C7 then C8. Identical rows fall out of the same keep-latest aggregate, so C7 costs no shuffle."""
    df = parse_datetimes(df, ["review_creation_date", "review_answer_timestamp"], fmt)
    return keep_latest(df, ["review_id", "order_id"], "review_answer_timestamp", nulls=nulls)


def transform_products(df: DataFrame) -> DataFrame:
    """Misspelled source columns renamed; a missing category stays NULL."""
    return rename_columns(df, BY_TABLE["products"].renames)


def transform_category_translation(df: DataFrame, collation: str | None = None) -> DataFrame:
    return keep_first(df, ["product_category_name"], collation=collation)


TRANSFORMS = {
    "customers": transform_customers,
    "sellers": transform_sellers,
    "geolocation": transform_geolocation,
    "product_category_translation": transform_category_translation,
    "products": transform_products,
    "orders": transform_orders,
    "order_items": transform_order_items,
    "order_payments": transform_payments,
    "order_reviews": transform_reviews,
}


def transform_all(raw: dict[str, DataFrame], collation: str | None = None) -> dict[str, DataFrame]:
    """C20: table name -> cleaned DataFrame, projected to the published schema."""
    out = {}
    for table, fn in TRANSFORMS.items():
        cleaned = fn(raw[table], collation=collation) if table == "product_category_translation" else fn(raw[table])
        names = BY_TABLE[table].schema.fieldNames()
        out[table] = cleaned.select(*names, *book_columns(cleaned.columns))
    return out

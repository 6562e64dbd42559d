"""Bounded, repeatable samples of labelled rows for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored


def held_out(doc_id: Column) -> Column:
    """Rows of the test fold: crc32 of the id as text, modulo 5, is 0 (a null id is held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


SLACK = 4  # rows of a class that reach the exact cut, as a multiple of those it keeps
BROADCAST_ROWS = 200_000  # up to so many sampled ids or classes (a few MB) are broadcast, more are joined by shuffle


def labelled_sample(labelled: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label) of at most ``per_class`` ids of each class: those with the smallest hashes.

    A bound on the hash, set from the size of the class, leaves about ``SLACK * per_class`` of its ids; only
    those are ordered for the exact cut, so no task sees a whole class, however many rows it has.
    """
    ids = labelled.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label")).where("doc_id is not null and label is not null")
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("place", F.xxhash64("doc_id"))
    share = F.least(F.lit(1.0), F.lit(SLACK * per_class) / F.count(F.lit(1)))
    # hashes are even over the range of a long
    bounds = stored(ids.groupBy("label").agg((F.lit(-(2.0**63)) + share * 2.0**64).alias("bound")), "sample-bounds")
    # a join dealt by label would bring a whole class into one task before the bound is looked at
    bounds = F.broadcast(bounds) if bounds.count() <= BROADCAST_ROWS else bounds
    near = ids.join(bounds, "label").where(F.col("place").cast("double") <= F.col("bound"))
    order = Window.partitionBy("label").orderBy("place", "doc_id")
    return near.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_class).select("doc_id", "label")


def with_texts(sample: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, label, text): one text of each sampled id, whatever its number of rows; ids without text are left out."""
    sample = stored(sample, "sample")
    few = F.broadcast(sample) if sample.count() <= BROADCAST_ROWS else sample
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(few, "doc_id")
    one = texts.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text").alias("h"), F.col("text"))).alias("text"))
    return one.where("text is not null").select("doc_id", "label", "text")

"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions only.

Every document has a 48-bit hash of its id. A source's budget is a number of full passes over all its
documents plus a rest. The rest is met by the documents below a hash threshold: sum the sizes by source
and leading hash bits, find the bucket in which the running sum passes the rest, and sum that bucket
again by its next bits, until all 48 bits are used. No document is sorted, and what is kept per source
is at most ``2 ** LEVEL_BITS`` sums at a time.

Defined results: a null text has size 0; a null source is a source of its own, after all others; rows
with one id (repeated rows) share a hash and are taken or left together; a null id hashes as the text
``null``; an empty table gives an empty mix. Other columns are passed on or ignored, and names of the
helper columns cannot clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
HASH_BITS = 48
LEVEL_BITS = 12


def size_column(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_column(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Targets share the total by weight and stop at ``max_repeats`` times a source's size; the excess goes
    to the others by weight. In the order of that limit per unit of weight, the stopped sources come
    first, so one pass of running sums finds the common level. Works on one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("place"))
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * max_repeats)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("limit").over(before), F.lit(0)))
        .withColumn("level", (F.col("total") - F.col("stopped")).cast("double") / F.sum("weight").over(after))
        .withColumn("order", F.row_number().over(by_limit))
        .withColumn("open", F.when(F.col("limit") >= F.col("level") * F.col("weight"), F.col("order")))
        .withColumn("common", F.min_by("level", "open").over(everything))
        .select("source", "source_size",
                F.least(F.col("limit").cast("double"), F.col("common") * F.col("weight")).alias("target"))
    )


def source_plan(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, target, passes, cut, take_cut) from (source, size, h): one row per source.

    A document of the source is taken ``passes`` times, once more if its hash is below ``cut``, or equal
    to it where ``take_cut`` says that this comes nearer to the target.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = stored(
        source_targets(sizes, weights, max_repeats)
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mixing-targets")
    # the rows inside the boundary bucket so far, and what lies below it; at first everything
    found = plan.select("source", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    for used in range(LEVEL_BITS, HASH_BITS + 1, LEVEL_BITS):
        rows = sized.withColumnsRenamed({"source": "s"}).withColumn("bucket", F.shiftright("h", HASH_BITS - used))
        inside = rows.join(found, F.col("s").eqNullSafe(F.col("source"))
                           & (F.shiftright("bucket", LEVEL_BITS) == F.col("prefix")))
        sums = inside.groupBy("source", "rest", "below", "bucket").agg(F.sum("size").alias("tokens"))
        running = F.sum("tokens").over(Window.partitionBy("source").orderBy("bucket"))
        found = (
            sums.withColumn("upto", F.col("below") + running)
            .where(F.col("upto") > F.col("rest"))
            .groupBy("source", "rest")
            .agg(F.min_by(F.struct("bucket", "upto", "tokens"), "bucket").alias("edge"))
            .select("source", "rest", F.col("edge.bucket").alias("prefix"),
                    (F.col("edge.upto") - F.col("edge.tokens")).alias("below"), F.col("edge.upto").alias("upto"))
        )
    cuts = found.select(F.col("source").alias("s"), F.col("prefix").alias("cut"),
                        (F.col("upto") - F.col("rest") < F.col("rest") - F.col("below")).alias("take_cut"))
    return plan.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "passes",
        F.coalesce("cut", F.lit(1 << HASH_BITS)).alias("cut"), F.coalesce("take_cut", F.lit(False)).alias("take_cut"))


def times_column(h: Column, max_repeats: int = MAX_REPEATS) -> Column:
    """How often the mix takes a document, beside the columns of ``source_plan``; documents without a word
    weigh nothing and so may lie below any cut, but none is taken more often than allowed."""
    more = (h < F.col("cut")) | ((h == F.col("cut")) & F.col("take_cut"))
    return F.least(F.col("passes") + F.when(more, 1).otherwise(0), F.lit(max_repeats))


def mixture(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every document (texts are read once)."""
    sized = stored(docs.select("doc_id", "source", size_column(F.col("text")).alias("size"),
                                hash_column(F.col("doc_id")).alias("h")), "mixing-sizes")
    plan = stored(source_plan(sized, weights, max_repeats), "mixing-plan").withColumnRenamed("source", "s")
    return sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * times_column(F.col("h"), max_repeats)).alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The rows of the mix: every document as often as it is taken, with its own columns."""
    sized = stored(docs.select("source", size_column(F.col("text")).alias("size"), hash_column(F.col("doc_id")).alias("h")),
                    "mixing-sizes")
    plan = stored(source_plan(sized, weights, max_repeats), "mixing-plan").withColumnRenamed("source", "s")
    rows = docs.select(F.struct(*docs.columns).alias("row"), hash_column(F.col("doc_id")).alias("h"))
    times = F.array_repeat(F.lit(0), times_column(F.col("h"), max_repeats).cast("int"))
    joined = rows.join(plan, F.col("row.source").eqNullSafe(F.col("s")))
    return joined.select("row", F.explode(times)).select("row.*")

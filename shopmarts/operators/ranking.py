"""Global ranking without a single-partition window.

``ntile(k) OVER (ORDER BY key)`` and ``dense_rank() OVER (ORDER BY key)`` over a whole table plan an
``Exchange SinglePartition`` in Spark: one task sorts every row.

NTILE needs only the last row of each of the first k-1 tiles. A sample of the ordering tuples (those
with the smallest hash, so it is the same on every run) splits the order into ``RANGES`` ranges; rows
are counted per range, and the ranges that hold one of those rows are split again, until ``RANGES`` to
the power of the rounds reaches ``spark.sql.shuffle.partitions``. Only what is left is sorted. Every row then gets
its tile by comparing its tuple with the k-1 found ones: no join, no full sort, no driver job.

DENSE_RANK numbers the distinct values: Spark's range partitioner sends each range to its own
partition, ``monotonically_increasing_id`` numbers the rows inside (upper bits: partition, lower 33
bits: place), and the rows before each range come from a frame of one row per range. Rows of the few
values that very many rows share are ranked in place; the others are joined with their value's rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.session import cut_lineage

RANGES = 128
SAMPLE_PER_RANGE = 8
HEAVY_VALUES = 64
_LOW33 = (1 << 33) - 1


def tile_cuts(df: DataFrame, k: int, order_cols: list[str], *, ranges: int | None = None) -> Column:
    """Ordering tuples of the last rows of tiles 1..k-1, as one array (a scalar subquery).

    ``order_cols`` (ascending, NULLs first) must make the order total. What is sorted by one task is a
    range: at most about 1/``spark.sql.shuffle.partitions`` of the rows, and at most k-1 ranges.
    """
    held, last = _cut_ranges(df, k, order_cols, max(2, ranges or RANGES))
    numbered = held.withColumn("place", F.row_number().over(Window.partitionBy("range").orderBy("key")))
    return numbered.join(last, ["range", "place"]).agg(F.collect_list("key")).scalar()


def _cut_ranges(df: DataFrame, k: int, order_cols: list[str], p: int) -> tuple[DataFrame, DataFrame]:
    """(key, range) of the rows in ranges that hold a cut, and (range, place) of the cuts."""
    keys = df.select(F.struct(*order_cols).alias("key"))
    sample = keys.orderBy(F.xxhash64("key"), "key").limit(p * SAMPLE_PER_RANGE)
    nth = F.expr(f"filter(ordered, (x, i) -> i % {SAMPLE_PER_RANGE} = {SAMPLE_PER_RANGE - 1})")
    bounds = sample.agg(F.array_sort(F.collect_list("key")).alias("ordered")).select(nth).scalar()
    # a scalar subquery cannot stand inside a higher-order function, so it becomes a column first
    ranged = keys.withColumn("bounds", bounds).select("key", F.size(F.filter("bounds", lambda b: b <= F.col("key"))).alias("range"))
    in_order = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sizes = (ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
             .withColumn("total", F.sum("n").over(Window.partitionBy())))
    whole, rest = F.expr(f"total div {k}"), F.expr(f"total % {k}")
    last = (sizes.withColumn("tile", F.explode(F.sequence(F.lit(1), F.lit(k - 1))))
            .withColumn("place", F.col("tile") * whole + F.least("tile", rest) - F.col("before"))
            .where("place between 1 and n").select("range", "place")) if k > 1 else sizes.where("false").select("range", F.lit(1).alias("place"))
    held = ranged.select("key", F.col("range").cast("long")).join(last.select("range").distinct(), "range", "left_semi")
    reached, wanted = p, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while reached < wanted:
        held, last = _split_again(held, last, k, p)
        reached *= p
    return held, last


def _split_again(held: DataFrame, last: DataFrame, k: int, p: int) -> tuple[DataFrame, DataFrame]:
    """The same with every range split into about ``p`` by a sample of its own."""
    nth = F.expr(f"filter(ordered, (x, i) -> i % {SAMPLE_PER_RANGE} = {SAMPLE_PER_RANGE - 1})")
    sample = held.orderBy(F.xxhash64("key"), "key").limit(p * SAMPLE_PER_RANGE * max(1, k - 1))
    bounds = sample.groupBy("range").agg(F.array_sort(F.collect_list("key")).alias("ordered")).select("range", nth.alias("bounds"))
    above = F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col("key"))), F.lit(0))
    parts = held.join(F.broadcast(bounds), "range", "left").select("key", "range", (F.col("range") * (p * k) + above).alias("part"))
    in_order = Window.partitionBy("range").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sizes = (parts.groupBy("range", "part").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0))))
    found = (sizes.join(last, "range").withColumn("place", F.col("place") - F.col("before"))
             .where("place between 1 and n").select(F.col("part").alias("range"), "place"))
    return parts.select("key", F.col("part").alias("range")).join(found.select("range").distinct(), "range", "left_semi"), found


def global_ntile(df: DataFrame, k: int, order_cols: list[str], out: str, *, ranges: int | None = None) -> DataFrame:
    """``ntile(k) OVER (ORDER BY order_cols)`` by cut tuples."""
    return global_ntiles(df, k, {out: order_cols}, ranges=ranges)


def global_ntiles(df: DataFrame, k: int, orders: dict[str, list[str]], *, ranges: int | None = None) -> DataFrame:
    """Several ``ntile(k) OVER (ORDER BY ...)`` columns of one frame; ``orders`` maps output to ordering
    columns (each a total order). The frame is read a few times: checkpoint it first if it is costly."""
    cuts = {f"_cuts{i}": tile_cuts(df, k, cols, ranges=ranges) for i, cols in enumerate(orders.values())}

    def tile(name: str, cols: list[str]) -> Column:
        key = F.struct(*cols)
        return (F.size(F.filter(name, lambda cut: cut < key)) + 1).cast("int")

    tiles = [tile(name, cols).alias(out) for name, (out, cols) in zip(cuts, orders.items())]
    return df.withColumns(cuts).select(*df.columns, *tiles)


def global_position(df: DataFrame, order: list[Column], out: str = "_pos", *, ranges: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in the given (total) order; one eager checkpoint.

    The checkpoint fixes the sampled range split, so positions and range counts come from the same one.
    """
    p = max(1, ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    numbered = cut_lineage(df.repartitionByRange(p, *order).sortWithinPartitions(*order)
                           .withColumn("_mid", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("_range", F.shiftright("_mid", 33))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = (numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
              .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")))
    place = (F.col("_start") + F.col("_mid").bitwiseAND(F.lit(_LOW33))).cast("long")
    return numbered.join(starts, "_range").withColumn(out, place).drop("_mid", "_range", "_start")


def global_dense_rank(df: DataFrame, value_col: str, out: str, *, descending: bool = True,
                      ranges: int | None = None) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value_col [DESC])`` for values of any ordered type.

    The distinct values (NULL is one: last in DESC, first in ASC) are numbered by position. Values that more
    than one row in ``HEAVY_VALUES`` has are so few (``HEAVY_VALUES`` at most) that they travel as one array: their
    rows are ranked where they lie and meet no join and no shuffle. All other rows are joined with their value's
    rank, and of none of those values is there much. The frame is read three times: checkpoint it first if it
    is costly.
    """
    value = F.col(value_col)
    values = df.groupBy(value.alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    order = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_first()
    numbered = global_position(values, [order], "_pos", ranges=ranges)
    ranked = numbered.select("_value", (F.col("_pos") + 1).cast("int").alias(out), "_rows")
    heavy = ranked.withColumn("_all", ranked.agg(F.sum("_rows")).scalar()).where(F.col("_rows") * HEAVY_VALUES > F.col("_all"))
    table = heavy.agg(F.collect_list(F.struct("_value", out))).scalar()
    marked = df.withColumn("_heavy", table).withColumn("_heavy", F.filter("_heavy", lambda h: h["_value"].eqNullSafe(value)))
    here = marked.where(F.size("_heavy") > 0).select(*df.columns, F.col("_heavy")[0][out].alias(out))
    rest = marked.where(F.size("_heavy") == 0).select(*df.columns)
    joined = rest.join(ranked.select("_value", out), value.eqNullSafe(F.col("_value"))).select(*df.columns, out)
    return here.unionByName(joined)


def top_dense_rank(df: DataFrame, value_col: str, tie_col: str, limit: int, out: str) -> DataFrame:
    """``dense_rank() OVER (ORDER BY value DESC)`` then ``LIMIT``: top-k first, rank the k rows.

    A row's descending dense rank depends only on the rows above it, and all of those are inside the
    top-k prefix, so ranking the prefix alone gives the global rank. Top-k is a parallel
    TakeOrderedAndProject; the window then sees at most ``limit`` rows.
    """
    top = df.orderBy(F.col(value_col).desc_nulls_last(), F.col(tie_col).asc()).limit(limit)
    w = Window.orderBy(F.col(value_col).desc_nulls_last())
    return top.withColumn(out, F.dense_rank().over(w))

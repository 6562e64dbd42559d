"""Whitening of embeddings with distributed block matrices.

Vectors become integers (``floor(SCALE * c)``), so sums and deviations are exact. Every row gets a number
without gaps; the fit list is the first row of each distinct vector. Its centred rows are indexed into the
blocks of an MLlib ``BlockMatrix``, and transpose times matrix gives the scatter, block by block, with the
inner dimension split over the executors. The driver decomposes that one square matrix, and the block matrix
of all centred rows times the whitening matrix projects them.

Blocks are a few MB and grow with the table (up to ``MOST_BLOCK_BYTES``), so that MLlib's plan of a product,
one coordinate a block, stays small. The driver sees sums and the scatter (dimensions squared), nothing that
grows with the rows.

Defined results: null vectors and vectors with null or non-finite entries are dropped; shorter vectors are
filled with zeros to the longest; equal rows and rows that share an id are rows of their own; entries beyond
the range of a long stay at its ends; a deviation beyond a long is null; a component without variance has
null whitened values (explained 0, or null if nothing varies) and no part in identity_error; fewer dimensions
than components give as many components; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored

SCALE = 256
COMPONENTS = 4
LEAST_BLOCK_BYTES, MOST_BLOCK_BYTES, BLOCKS = 1 << 20, 1 << 26, 1 << 15
TASK_BYTES = 1 << 26
EMPTY_VARIANCE = 1e-13  # of the largest: beyond what rounding leaves of no variance


def numbered_rows(table: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(row, id, x): the whole vectors as integers, numbered from 0 without gaps."""
    entries = F.col(vector_column).cast("array<double>")
    whole = F.coalesce(F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < math.inf), F.lit(False))), F.lit(False))
    x = F.transform(entries, lambda c: F.floor(c * SCALE).cast("long"))
    kept = table.where(whole).select(F.col(id_column).alias("id"), x.alias("x"))
    kept = stored(kept.withColumn("mark", F.monotonically_increasing_id()), "whitening-rows")
    part = F.shiftrightunsigned("mark", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # one row a file
    if not sizes:
        return kept.select(F.col("mark").alias("row"), "id", "x")
    ends = np.cumsum([r.n for r in sizes]).tolist()
    offsets = kept.sparkSession.createDataFrame([(r.part, e - r.n) for r, e in zip(sizes, ends)], "part long, offset long")
    within = F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.withColumn("part", part).join(offsets, "part").select((F.col("offset") + within).alias("row"), "id", "x")


def _integers(column: pa.Array, dimensions: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows, filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dimensions), np.int64)
    out[np.arange(dimensions)[None, :] < sizes[:, None]] = flat
    return out


def column_sums(fit: DataFrame, dimensions: int) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches):
        total = [0] * dimensions
        for batch in batches:
            x = _integers(batch.column(0), dimensions)
            small = not x.size or float(np.abs(x.astype(float)).max()) * len(x) < 2.0**62
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0) if small else x.astype(object).sum(axis=0))]
        yield pa.RecordBatch.from_pylist([{"dimension": k, "total": str(t)} for k, t in enumerate(total)],
                                         schema=pa.schema([("dimension", pa.int32()), ("total", pa.string())]))

    parts = fit.select("x").mapInArrow(run, "dimension int, total string")
    sums = parts.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    by_dimension = {r.dimension: int(r.total) for r in sums}
    return [by_dimension.get(k, 0) for k in range(dimensions)]


def deviations(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """(row, id, deviation): the sum over dimensions of (n x - S) squared, exact."""
    dimensions = len(sums)
    top = max(map(abs, sums), default=0)

    def run(batches):
        exact = np.array(sums, object)
        for batch in batches:
            x = _integers(batch.column(2), dimensions)
            most = n * float(np.abs(x.astype(float)).max(initial=0)) + top
            if most * most * dimensions < 2.0**62:
                away = n * x - exact.astype(np.int64)
                total = (away * away).sum(axis=1).tolist()
            else:
                away = n * x.astype(object) - exact
                total = [t if t < 1 << 63 else None for t in (away * away).sum(axis=1).tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64())], names=["row", "id", "deviation"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("row", "id", "x").mapInArrow(run, f"row long, id {id_type}, deviation long")


def _block_rows(n_rows: int, dimensions: int) -> int:
    row_bytes = 8 * max(dimensions, 1)
    block = min(max(LEAST_BLOCK_BYTES, n_rows * row_bytes // BLOCKS), MOST_BLOCK_BYTES)
    return max(1, block // row_bytes)


def centred_matrix(rows: DataFrame, n_rows: int, means: list[float]) -> BlockMatrix:
    """Block matrix of the rows' centred vectors; rows that are not there count as zeros."""
    dimensions = len(means)
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size("x")))
    centred = F.zip_with(filled.cast("array<double>"), F.lit(means), lambda c, mean: c - mean)
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("row", array_to_vector(centred).alias("vector")), "vector")
    tasks = -(-n_rows * dimensions * 8 // TASK_BYTES)
    if vectors.rdd.getNumPartitions() < tasks:
        vectors = vectors.repartition(tasks)
    return IndexedRowMatrix(vectors, n_rows, dimensions).toBlockMatrix(_block_rows(n_rows, dimensions), max(dimensions, 1))


def scatter(centred: BlockMatrix) -> np.ndarray:
    """Transpose times matrix; its inner dimension is dealt to as many tasks as hold TASK_BYTES each."""
    splits = max(1, -(-centred.numRows() * centred.numCols() * 8 // TASK_BYTES))
    # the Python wrapper of multiply leaves out the JVM method's number of splits
    product = centred.transpose()._java_matrix_wrapper.call("multiply", centred._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, centred.colsPerBlock, centred.colsPerBlock).toLocalMatrix().toArray()


def projected(centred: BlockMatrix, directions: np.ndarray) -> DataFrame:
    """(row, values): the rows times the columns of ``directions``."""
    spark_context = centred.blocks.context
    d, k = directions.shape
    small = BlockMatrix(spark_context.parallelize([((0, 0), Matrices.dense(d, k, directions.ravel(order="F").tolist()))], 1), centred.colsPerBlock, k)
    product = centred.multiply(small).toIndexedRowMatrix()
    rows = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    rows = MLUtils.convertVectorColumnsToML(rows, "vector")
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("values"))


def identity_error(values: DataFrame, n: int, components: list[int]) -> float | None:
    """Largest absolute entry of the values' covariance minus the identity; None without components."""
    if not components:
        return None
    value = F.col("values")
    means = values.select(*[F.avg(value[k]) for k in components]).first()
    away = {k: value[k] - F.lit(m) for k, m in zip(components, means)}
    pairs = [(a, b) for a in components for b in components if a <= b]
    sums = values.select(*[F.sum(away[a] * away[b]) for a, b in pairs]).first()
    return max(abs(s / n - (a == b)) for s, (a, b) in zip(sums, pairs))


def whitened(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error for each whole vector and component."""
    rows = stored(numbered_rows(table, id_column, vector_column), "whitening-numbered")
    n_rows, dimensions = rows.select(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n_rows or not dimensions:
        id_type = rows.schema["id"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"`{id_column}` {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dimensions) - F.size("x")))
    fit = stored(rows.groupBy(filled.alias("x")).agg(F.min("row").alias("row")), "whitening-fit")
    n = fit.count()
    sums = column_sums(fit, dimensions)
    means = [s / n for s in sums]

    variance, vectors = np.linalg.eigh(scatter(centred_matrix(fit, n_rows, means)) / n)
    order = np.argsort(-variance, kind="stable")[:components]
    top, total = variance[order], float(variance.sum())
    real = top > EMPTY_VARIANCE * max(top[0], 0.0)
    directions = vectors[:, order] / np.sqrt(np.where(real, top, 1.0))
    explained = [float(max(e, 0.0) / total) if total > 0 else None for e in top]

    values = stored(projected(centred_matrix(rows, n_rows, means), directions), "whitening-values")
    shown = np.flatnonzero(real).tolist()
    error = identity_error(values.join(fit.select("row"), "row", "left_semi"), n, shown)
    parts = F.array(*[F.struct(F.lit(k + 1).alias("component"), (F.col("values")[k] if k in shown else F.lit(None).cast("double")).alias("whitened"),
                               F.lit(explained[k]).cast("double").alias("explained")) for k in range(len(order))])
    return deviations(rows, n, sums).join(values, "row").select("id", "deviation", F.inline(parts)).select(
        F.col("id").alias(id_column), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error"))

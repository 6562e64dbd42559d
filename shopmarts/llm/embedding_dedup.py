"""Near-duplicate embeddings by spherical-cap filters from structured random product codes.

After a random rotation a vector is split into ``PARTS`` parts. Each part has a random code of unit
vectors, and one code word per part makes a filter direction, so a few dozen code words span a great
many directions. A vector is decoded to the list of its ``BEST`` directions, those with the greatest
inner products: no vector is without filters, whatever the number of directions. Vectors of one label
that share a filter are compared in double precision; equal vectors are one class beforehand.

A code grows with the number of vectors (``FILTERS_PER_VECTOR`` directions for each), so that a filter
keeps few of them, and a pair meets in one code less often the larger it is. So independent codes are
joined until they miss at most ``MISS`` of ``PLANTED`` random pairs at the least cosine; where
``MOST_CODES`` do not reach that (short vectors in great number), all codes get fewer directions.
Members of a filter meet in blocks of about ``BLOCK`` vectors, every pair of blocks a group of its own,
and only links leave a block.

Defined results: a null label, a null or empty vector, null or non-finite components or a zero vector
link with nothing; vectors of different length never link; rows that share an id are vectors of their
own that all count as links.
"""

from __future__ import annotations

import itertools
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.components import components
from shopmarts.llm.stored import stored

MIN_COSINE = 0.93
PARTS = 3
LEAST_PART = 4
FILTERS_PER_VECTOR = 4
LEAST_FILTERS = 4096
MOST_WORDS = 1 << 15
BEST = 8
MOST_CODES = 16
PLANTED = 2000
MISS = 0.005
BLOCK = 256
SEED = 11


class _Code:
    """Filter directions for vectors of one length."""

    def __init__(self, dimensions: int, n_filters: int, number: int):
        rng = np.random.default_rng([SEED, dimensions, number])
        parts = max(1, min(PARTS, dimensions // LEAST_PART))
        self.rotation = np.linalg.qr(rng.normal(size=(dimensions, dimensions)))[0]
        self.cuts = np.linspace(0, dimensions, parts + 1).astype(int)
        self.words = min(MOST_WORDS, max(BEST, math.ceil(n_filters ** (1 / parts))))
        self.codes = []
        for a, b in zip(self.cuts[:-1], self.cuts[1:]):
            code = rng.normal(size=(self.words, b - a))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        # a direction among the BEST has at most BEST - 1 others whose words all rank as high or higher
        ranks = itertools.product(range(BEST), repeat=parts)
        self.ranks = np.array([r for r in ranks if math.prod(k + 1 for k in r) <= BEST])

    def decode(self, units: np.ndarray) -> np.ndarray:
        """The filters of every vector, one row of BEST for each."""
        turned = units @ self.rotation
        total, filters = np.zeros((len(units), len(self.ranks))), np.zeros((len(units), len(self.ranks)), np.int64)
        for i, code in enumerate(self.codes):
            scores = turned[:, self.cuts[i] : self.cuts[i + 1]] @ code.T
            word = np.argpartition(-scores, BEST - 1, axis=1)[:, :BEST]
            word = np.take_along_axis(word, np.argsort(-np.take_along_axis(scores, word, axis=1), axis=1, kind="stable"), axis=1)
            total += np.take_along_axis(scores, word, axis=1)[:, self.ranks[:, i]]
            filters = filters * self.words + word[:, self.ranks[:, i]]
        return np.take_along_axis(filters, np.argpartition(-total, BEST - 1, axis=1)[:, :BEST], axis=1)


def planted_pairs(dimensions: int, cosine: float, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and for each another one at this cosine."""
    x, y = np.random.default_rng([seed, dimensions]).normal(size=(2, n, dimensions))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dimensions == 1:
        return x, x
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    return x, cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * y


def _share(dimensions: int, cosine: float) -> float:
    """The share of all directions that lie within this cosine of one."""
    angle = np.linspace(0, math.pi, 20001)
    weight = np.sin(angle) ** max(0, dimensions - 2)
    return float(weight[np.cos(angle) >= cosine].sum() / weight.sum())


class ProductCode:
    """Independent codes for vectors of one length, as many as pairs at the least cosine need to meet."""

    def __init__(self, dimensions: int, n_vectors: int, min_cosine: float = MIN_COSINE):
        # no more than leave the BEST of a vector spread as wide as its links
        n_filters = int(min(max(LEAST_FILTERS, FILTERS_PER_VECTOR * n_vectors), BEST / max(_share(dimensions, min_cosine), 1e-18)))
        x, y = planted_pairs(dimensions, min_cosine, PLANTED, SEED)
        while True:
            self.codes: list[_Code] = []
            apart, left = np.arange(PLANTED), 1.0
            # codes miss independently: what all of them would leave apart is known early
            while len(apart) > MISS * PLANTED and (not self.codes or left ** (MOST_CODES / len(self.codes)) <= MISS) and len(self.codes) < MOST_CODES:
                code = _Code(dimensions, n_filters, len(self.codes))
                self.codes.append(code)
                apart = np.concatenate([k[~self._meet(code, x[k], y[k])] for k in np.array_split(apart, -(-len(apart) // 256))])
                left = len(apart) / PLANTED
            if left <= MISS or n_filters <= BEST:
                return
            n_filters //= 4

    @staticmethod
    def _meet(code: _Code, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (code.decode(x)[:, :, None] == code.decode(y)[:, None, :]).any(axis=(1, 2))

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter): the best directions of every vector in every code."""
        filters = np.concatenate([code.decode(units) * MOST_CODES + k for k, code in enumerate(self.codes)], axis=1)
        return np.repeat(np.arange(len(units)), filters.shape[1]), filters.ravel()


@lru_cache(maxsize=16)
def _product_code(dimensions: int, n_vectors: int, min_cosine: float) -> ProductCode:
    return ProductCode(dimensions, n_vectors, min_cosine)


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, length, vector, name): vector as doubles and its digest, null where it links with nothing."""
    sound = F.expr("label is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
                   " and exists(embedding, x -> x <> 0)")
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("length", pa.int32()), ("vector", pa.binary())])

    def run(batches):
        for batch in batches:
            values = batch.column(2)
            out, sizes = [], []
            for v in values:
                v = None if not v.is_valid else np.asarray(v.values.to_numpy(zero_copy_only=False), "<f8") + 0.0  # no negative zeros
                out.append(None if v is None else v.tobytes())
                sizes.append(None if v is None else len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(out, pa.binary())], schema=schema)

    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), F.when(sound, F.col("embedding")).alias("embedding"))
    out = rows.mapInArrow(run, "vec_id long, label string, length int, vector binary")
    return out.withColumn("name", F.when(F.col("vector").isNotNull(), F.md5("vector")))


def _units(column) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so that no square overflows."""
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links(classes: DataFrame, n_vectors: int, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(a, b), a < b, of the classes(id, label, length, vector) found with this cosine or more."""

    def decode(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                code = _product_code(d, n_vectors, min_cosine)
                mine = batch.filter(pa.array(sizes == d))
                for k in range(0, mine.num_rows, 256):
                    part = mine.slice(k, 256)
                    row, filter_ = code.decode(_units(part.column(3)))
                    row = pa.array(row)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), part.column(2).take(row), pa.array(filter_)],
                                                     names=["id", "label", "length", "filter"])

    key = ["label", "length", "filter"]
    caught = stored(classes.select("id", "label", "length", "vector").mapInArrow(decode, "id long, label string, length int, filter long"), "cap-filters")
    shared = caught.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).where("members > 1").select(*key, F.ceil(F.col("members") / BLOCK).cast("int").alias("n_blocks"))
    members = caught.join(shared, key).withColumn("mine", F.pmod(F.xxhash64("id"), "n_blocks").cast("int"))
    # a block meets every block, itself included, once: the group of blocks i <= j holds the members of both
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    met = met.select("id", *key, "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    met = met.join(classes.select("id", "vector"), "id")

    def compare(table: pa.Table) -> pa.Table:
        ids, mine = table.column("id").to_numpy(), table.column("mine").to_numpy()
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        units = _units(table.column("vector"))
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        x, y = np.nonzero(units[left] @ units[right].T >= min_cosine)
        a, b = ids[left[x]], ids[right[y]]
        once = a < b if i == j else a != b
        return pa.table({"a": np.minimum(a, b)[once], "b": np.maximum(a, b)[once]})

    return met.groupBy(*key, "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_vectors(embeddings: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    vectors = stored(_vectors(embeddings), "cap-vectors")
    name = ["label", "length", "name"]
    sound = vectors.where("vector is not null")
    named = sound.groupBy(*name).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.min("vector").alias("vector"))
    classes = stored(named.where("id is not null"), "cap-classes")
    found = stored(links(classes, classes.count(), min_cosine), "cap-links")
    size = classes.select(F.col("id").alias("b"), "copies")
    both = found.union(found.select("b", "a")).toDF("a", "b")
    beside = both.join(size, "b").groupBy("a").agg(F.sum("copies").alias("beside")).withColumnRenamed("a", "id")
    placed = classes.select(*name, "id", "copies").join(beside, "id", "left").join(components(found), "id", "left").select(
        *name, (F.col("copies") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component"))
    return vectors.join(placed, name, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"))

"""Near-duplicate documents by SetSketch registers.

A document is its set of 5-word shingles (64-bit hashes). Register i is the least of the set's i-th
exponential values, on a logarithmic scale of base ``BASE`` cut to 16 bits: exponentially spaced,
mergeable by maximum, and two sets agree in it about as often as their Jaccard similarity. Equal sets
are one class. Classes meet in the buckets of ``BANDS`` bands of ``ROWS`` registers, which are cut from
several orders of the registers. The bands share registers, so how often a pair misses all of them is
simulated: once in 1.2 million pairs at 0.75, none at 0.76. Texts that only share a common passage
(similarity 0.3) meet in about one case of a hundred. The joint likelihood of the registers estimates the similarity and
drops pairs ``MARGIN`` below the threshold (five standard deviations); the others are verified on full
shingle sets.

Within a bucket, all members are first compared with its least class. Classes that then stand outside the
largest component of one of their buckets may still link with any other member, and comparing them with all
would take a row for each pair of a family. So they meet on an exact prefix index instead: the shingles of a
class are put in one order, the rarest first, and of two classes of m and n shingles that link, at least
t = 75 (m + n) / 175 are common, so the first common one is among the first m - t + 1 of the one and the first
n - t + 1 of the other. Texts a little below the threshold differ in more shingles than that, rare ones, and
do not meet. Every pair of a bucket is either compared, connected, or proven no link.

Classes have numbers of their own; the id of a document is only the label of a component.

Defined results: null, empty and blank texts have no shingles and link with nothing; 1 to 4 words are
one shingle; an id is one document whatever its number of rows: all their texts' links are its links, and
its rows share a component and its decision (a row without shingles stays alone); a null id links like any
other but is never a component's id, and a component of null ids only keeps them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopmarts.llm.components import components
from shopmarts.llm.stored import bounded_batches, stored
from shopmarts.llm.textblocks import U64, SpanHasher, blocks, gram_hashes, mix64, word_bounds

SHINGLE = 5
PERCENT = 75
REGISTERS = 256
BANDS, ROWS = 192, 8
BASE = 1.001
SCALE = 64.0
MARGIN = 0.15
BLOCK = 1 << 18  # bytes of text worked on together

_FACTORS = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)) | U64(1)
# the registers of each band: whole orders of all registers, one after another, cut into bands
_ORDERS = np.concatenate([np.random.default_rng(k).permutation(REGISTERS) for k in range(-(-BANDS * ROWS // REGISTERS))])
_BANDED = _ORDERS[: BANDS * ROWS]
_SHIFTS = mix64(np.arange(1, REGISTERS + 1, dtype=np.uint64) * U64(0xC2B2AE3D27D4EB4F))


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles, sorted by row, then hash."""
    start, end, row = word_bounds(data, offsets)
    words = SpanHasher(data, lower=True)(start, end)
    grams, first = gram_hashes(words, row, SHINGLE)
    rows = row[first]
    per_row = np.bincount(row, minlength=len(offsets) - 1)
    few = np.flatnonzero((per_row > 0) & (per_row < SHINGLE))
    if len(few):
        at = np.concatenate([[0], np.cumsum(per_row)])[few]
        h = mix64(per_row[few].astype(np.uint64))
        for k in range(SHINGLE - 1):
            more = per_row[few] > k
            h[more] = mix64(h[more] * U64(0x9FB21C651E98DF25) + words[at[more] + k])
        grams, rows = np.concatenate([grams, h]), np.concatenate([rows, few])
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    return grams[new], rows[new]


def registers(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SetSketch registers of the sets that start at ``starts``: one row of uint16 for each."""
    out = np.empty((len(starts), REGISTERS), np.uint16)
    for i in range(REGISTERS):
        value = grams * _FACTORS[i]
        value += _SHIFTS[i]
        least = np.minimum.reduceat(value, starts).astype(float)
        least = -np.log1p(-(least + 0.5) / 2.0**64 * (1 - 1e-12))
        level = np.floor(1 - np.log(least / SCALE) / math.log(BASE))
        out[:, i] = np.clip(level, 0, 65535)
    return out


def _set_keys(grams: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Two sums over each row's set, which with its size name the set."""
    keys = np.zeros((2, n), np.uint64)
    size = np.bincount(rows, minlength=n)
    filled = np.flatnonzero(size)
    if len(filled):
        starts = (np.cumsum(size) - size)[filled]
        for k, salt in enumerate((0x1B873593CC9E2D51, 0x85EBCA6B0F3C6EF3)):
            keys[k, filled] = np.add.reduceat(mix64(grams ^ U64(salt)), starts)
    return keys


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, key1, key2, registers): the keys are sums over the set and name it."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key1", pa.int64()), ("key2", pa.int64()), ("registers", pa.binary())])

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in blocks(batch.column(1), BLOCK):
                n = end - row
                grams, rows = shingle_sets(data, offsets)
                size = np.bincount(rows, minlength=n)
                filled = np.flatnonzero(size)
                starts = np.concatenate([[0], np.cumsum(size)])[filled]
                keys = _set_keys(grams, rows, n)
                sketch: list = [None] * n
                if len(filled):
                    for i, r in zip(filled.tolist(), registers(grams, starts).astype("<u2")):
                        sketch[i] = r.tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0)[row:end], pa.array(size, pa.int64()), pa.array(keys[0].view(np.int64)),
                                                  pa.array(keys[1].view(np.int64)), pa.array(sketch, pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_shingles long, key1 long, key2 long, registers binary")


def jaccard_estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of each pair of sketches, the set sizes being known."""
    above, below = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    value = above * np.log(np.maximum(up, tiny)) + below * np.log(np.maximum(down, tiny)) + (a.shape[1] - above - below) * np.log(np.maximum(1 - up - down, tiny))
    return np.take_along_axis(j, value.argmax(axis=1)[:, None], axis=1)[:, 0]


def _stack(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose estimate comes near the threshold."""
    side = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    near = (F.col("n_a") * PERCENT <= F.col("n_b") * 100) & (F.col("n_b") * PERCENT <= F.col("n_a") * 100)
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                sizes = [part.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (2, 3)]
                keep = jaccard_estimates(_stack(part.column(4), "<u2"), _stack(part.column(5), "<u2"), *sizes) >= PERCENT / 100 - MARGIN
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets meet the threshold."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("shingles").alias(f"s_{c}"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, shingles) of these classes (id, n, key1, key2, label): the sorted hashes of one whole text of each."""
    labels = classes.select("label").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(labels, F.col("doc_id").eqNullSafe(F.col("label")), "left_semi").select("text")

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in blocks(batch.column(0), BLOCK):
                grams, rows = shingle_sets(data, offsets)
                cuts = np.searchsorted(rows, np.arange(end - row + 1))
                keys = _set_keys(grams, rows, end - row)
                out = [grams[a:b].astype("<u8").tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.diff(cuts)), *(pa.array(k.view(np.int64)) for k in keys), pa.array(out, pa.binary())],
                                                 names=["n", "key1", "key2", "shingles"])

    sets = texts.mapInArrow(run, "n long, key1 long, key2 long, shingles binary")
    return sets.join(classes.select("id", "n", "key1", "key2"), ["n", "key1", "key2"]).groupBy("id").agg(F.first("shingles").alias("shingles"))


def _banded(classes: DataFrame) -> DataFrame:
    """(key, id): the bucket of every band of every class."""

    def run(batches):
        salt = mix64(np.arange(1, BANDS + 1, dtype=np.uint64) * U64(0x8CB92BA72F3D8DD7))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                words = np.ascontiguousarray(_stack(part.column(1), "<u2")[:, _BANDED]).view("<u8").reshape(part.num_rows, BANDS, ROWS // 4)
                keys = np.broadcast_to(salt, (part.num_rows, BANDS))
                for w in range(ROWS // 4):
                    keys = mix64(keys * U64(0x9FB21C651E98DF25) + words[:, :, w])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part.column(0).to_numpy(), BANDS))], names=["key", "id"])

    return classes.select("id", "registers").mapInArrow(run, "key long, id long")


def _prefix_index(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, shingle, at, n): the leading shared shingles of each class, the rarest first, and their places.

    Shingles that no other class has come first of all and meet nobody, so they only count.
    """

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                grams = np.frombuffer(batch.column(1)[k].as_buffer(), "<i8")
                for at in range(0, len(grams), 1 << 16):
                    part = grams[at : at + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), batch.column(0)[k].as_py())), pa.array(part)], names=["id", "shingle"])

    held = sets.join(classes.select("id"), "id", "left_semi").select("id", "shingles").mapInArrow(run, "id long, shingle long")
    common = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = held.join(common, "shingle")
    whole = Window.partitionBy("id")
    placed = shared.join(classes, "id").withColumn("at", F.row_number().over(whole.orderBy("df", "shingle")) - 1 + F.col("n") - F.count(F.lit(1)).over(whole))
    return placed.where(f"(n - at) * 100 >= n * {PERCENT}").select("id", "shingle", "at", "n", "component", "minor")


def _prefix_pairs(index: DataFrame) -> DataFrame:
    """(a, b) of different components, one of them minor, that share a leading shingle early enough in both.

    The smaller of two needs few leading shingles (those it needs for a class of its own size), so only
    those are laid out for the larger ones to meet.
    """
    side = lambda rows, c: rows.select("shingle", *[F.col(k).alias(f"{k}_{c}") for k in ("id", "at", "n", "component")])
    short = index.where(f"(n - at) * {100 + PERCENT} >= {2 * PERCENT} * n")
    larger = "(n_l > n_s OR n_l = n_s AND id_l > id_s)"
    early = " AND ".join(f"(n_{c} - at_{c}) * {100 + PERCENT} >= {PERCENT} * (n_l + n_s)" for c in "ls")
    meets = F.expr(f"{larger} AND component_l <> component_s AND n_s * 100 >= {PERCENT} * n_l AND {early}")
    ways = [side(index.where("minor"), "l").join(side(short, "s"), "shingle").where(meets),
            side(index.where("not minor"), "l").join(side(short.where("minor"), "s"), "shingle").where(meets)]
    return ways[0].unionByName(ways[1]).select(F.least("id_l", "id_s").alias("a"), F.greatest("id_l", "id_s").alias("b")).distinct()


def linked_classes(docs: DataFrame, classes: DataFrame, known: DataFrame) -> DataFrame:
    """(id, component) of the classes(id, n, key1, key2, registers) that link with another; ``known`` are
    links (a, b) that hold anyway."""
    banded = _banded(classes)
    # most buckets hold one class: count first, with nothing but the key
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = stored(banded.join(shared.select("key"), "key"), "near-members")
    leaders = members.groupBy("key").agg(F.min("id").alias("leader"))
    sets = stored(_full_sets(docs, classes.join(members.select("id").distinct(), "id", "left_semi")), "near-sets")

    first = members.join(leaders, "key").where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(_verified(_likely(first, classes), sets).unionByName(known), "near-links")
    found = components(links)

    placed = members.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main")).where("parts > 1").select("key", "main")
    mixed = placed.join(largest, "key").groupBy("id", "component").agg(F.max(F.col("component") != F.col("main")).alias("minor"))
    mixed = stored(mixed.join(classes.select("id", "n"), "id"), "near-mixed")
    index = stored(_prefix_index(sets, mixed), "near-prefixes")
    rest = _prefix_pairs(index).join(first, ["a", "b"], "left_anti")
    more = stored(_verified(_likely(rest, classes), sets), "near-links")
    if more.isEmpty():
        return found
    return components(links.unionByName(more))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    bounded_batches(docs.sparkSession)
    sketched = stored(sketches(docs), "near-sketches")
    key = ["n_shingles", "key1", "key2"]
    filled = sketched.where("n_shingles > 0")
    named = filled.groupBy(*key).agg(F.min("doc_id").alias("label"), F.first("registers").alias("registers"))
    classes = named.select(F.monotonically_increasing_id().alias("id"), F.col("n_shingles").alias("n"), "key1", "key2", "label", "registers")
    classes = stored(classes, "near-classes")
    name = classes.select("id", F.col("n").alias("n_shingles"), "key1", "key2")
    held = filled.select("doc_id", *key).where("doc_id is not null").join(name, key).select("doc_id", "id").distinct()
    several = held.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z")
    known = held.join(several, "doc_id").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    found = linked_classes(docs, classes, known)
    placed = classes.join(found, "id", "left").select("id", "n", "key1", "key2", "label", F.coalesce("component", "id").alias("component"))
    labels = placed.groupBy("component").agg(F.min("label").alias("component_id"))
    by_key = placed.join(labels, "component").select(F.col("n").alias("n_shingles"), "key1", "key2", "component_id")
    return sketched.join(by_key, key, "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.coalesce("component_id", "doc_id")).alias("kept"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """The rows of documents that stay: one of each group, the smallest id."""
    gone = near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    gone = stored(gone, "near-gone")
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.join(gone, F.col("row.doc_id").cast("long") == F.col("gone_id"), "left_anti").select("row.*")

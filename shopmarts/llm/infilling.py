"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put together in another order.

A text is a run of units: code points, words with the white space after them, or lines. Its bytes are
taken in blocks of ``BLOCK_BYTES``, and two Fenwick trees over the blocks hold how many units and how
many code points begin in each. The block of a cut is found by binary lifting (one descent gives the
block, the units and the code points before it), and only that block is searched for the boundary.

Where the cuts lie and what form a document takes is decided by sha256 of the seed and its id, so runs
agree on any cluster. ``restored`` gives the exact text back from output and form.

Defined results: a null text is empty, and empty texts are plain; a text that holds a marker is plain,
so the markers of an output are the only ones in it; a null id is hashed as ``null``; rows that share an
id share its hash and are cut by their own texts; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.textblocks import blocks, space_mask

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
INFILLED_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20
BLOCK_BYTES = 4096
UNITS = ("code_point", "word", "line")


class Fenwick:
    """Sums over blocks: row ``k`` of ``counts`` holds what is counted in block k, one column per kind."""

    def __init__(self, counts: np.ndarray):
        self.tree = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
        self.tree[1:] = np.cumsum(counts, axis=0)
        self.total = self.tree[-1].tolist()
        ends = np.arange(1, len(counts) + 1)
        # node i covers the blocks since i without its lowest bit
        self.tree[1:] -= self.tree[ends & (ends - 1)]
        self.top = 1 << (len(counts).bit_length() - 1) if len(counts) else 0

    def descend(self, target: int) -> tuple[int, list[int]]:
        """(block in which unit number ``target`` begins, what is counted before that block)."""
        at, step, before = 0, self.top, [0] * self.tree.shape[1]
        while step:
            ahead = at + step
            if ahead < len(self.tree) and before[0] + self.tree[ahead, 0] <= target:
                at, before = ahead, [int(b + t) for b, t in zip(before, self.tree[ahead])]
            step >>= 1
        return at, before


def code_point_starts(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    """Marks the first byte of each unit; a text's first byte begins one."""
    if unit == "code_point":
        starts = code_point_starts(data)
    else:
        before = data[:-1]
        starts = np.ones(len(data), bool)
        starts[1:] = before == 0x0A if unit == "line" else space_mask(before) & ~space_mask(data[1:])
    starts[:1] = True
    return starts


class Cutter:
    """Finds unit boundaries of one text."""

    def __init__(self, data: np.ndarray, unit: str, block_bytes: int = BLOCK_BYTES):
        self.data, self.unit, self.block_bytes = data, unit, block_bytes
        self.units, self.points = unit_starts(data, unit), code_point_starts(data)
        first = np.arange(0, len(data), block_bytes)
        counts = [np.add.reduceat(mask, first, dtype=np.int64) if len(data) else np.zeros(0, np.int64) for mask in (self.units, self.points)]
        self.tree = Fenwick(np.column_stack(counts))
        self.n = self.tree.total[0]

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code points before it) at which the first ``units`` units end."""
        if units >= self.n:
            return len(self.data), self.tree.total[1]
        block, (seen, points) = self.tree.descend(units)
        start = block * self.block_bytes
        inside = int(np.flatnonzero(self.units[start : start + self.block_bytes])[units - seen])
        return start + inside, points + int(np.count_nonzero(self.points[start : start + inside]))


def infilled(docs: DataFrame, unit: str = "code_point", seed: int = SEED, infilled_percent: int = INFILLED_PERCENT,
             suffix_first_percent: int = SUFFIX_FIRST_PERCENT, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain) and output."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def place(doc_id, data: np.ndarray):
        cutter = Cutter(data, unit, block_bytes)
        text = data.tobytes()
        key = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(key[8 * k : 8 * k + 8], 16) for k in range(4))
        n = cutter.n
        if not text or h3 % 100 >= infilled_percent or p in text or s in text or m in text:
            return n, "plain", None, None, text
        (a, before), (b, upto) = (cutter.cut(k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
        if h4 % 100 < suffix_first_percent:
            return n, "spm", before, upto - before, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
        return n, "psm", before, upto - before, b"".join((p, text[:a], s, text[b:], m, text[a:b]))

    def run(batches):
        for batch in batches:
            for row, end, data, offsets in blocks(batch.column(1)):
                ids = batch.column(0)[row:end]
                n, form, prefix, middle, output = zip(*(place(i, data[x:y]) for i, x, y in zip(ids.to_pylist(), offsets[:-1], offsets[1:])))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                     pa.array(output, pa.binary()).view(pa.string())], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""

    def after(text: Column, part: Column) -> Column:
        return F.substring(text, F.length(part) + F.lit(len(PREFIX) + 1), F.length(text))

    body = F.substring(output, F.lit(len(PREFIX) + 1), F.length(output))
    first = F.when(form == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    rest = after(body, first)
    second = F.substring_index(rest, MIDDLE, 1)
    middle = after(rest, second)
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)

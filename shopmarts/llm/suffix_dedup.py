"""Removal of repeated byte strings by a common-prefix-aware distributed merge sort of suffixes.

Every byte covered by a ``LENGTH``-byte string that also starts in a document with a smaller id goes.
Suffixes are sorted only where they can matter:

1. Anchors. Of the ``GRAM``-byte strings in every ``LENGTH``-byte window, those with the least hash are
   its anchors, so two equal windows hold equal anchors at the same places. Exact copies of a whole text
   are known by digest and stay out of all that follows.
2. Shared fingerprints. Blocks of documents exchange the sorted fingerprints of their anchors, cut to 40
   bits below the bucket; those found in two documents come back. (A chance match costs work, not truth.)
3. Merge sort. A block sorts the suffixes at its shared anchors: the text from the anchor to ``LENGTH``
   bytes, then what stands before it, read backwards. Equal suffixes of a block are sent once, with the
   least and the greatest document. Runs are front-coded (each suffix without the prefix it has in common
   with the one before) and dealt by the anchor's fingerprint. A loser tree merges them; its nodes know
   the common prefix with the last winner, so no known prefix is compared again.
4. Suffixes with one anchor are neighbours now. Their common prefixes (text after the anchor) and common
   backward parts (text before it) say which windows they share, and the least document of each.
5. The answers go back to the blocks, which mark and cut the bytes.

Documents are dealt to blocks by id, so what a task holds is bounded by the block and bucket sizes; a
hot passage is one suffix per block. Texts travel by block twice.

Defined results: a null text is empty; texts shorter than ``LENGTH`` stay whole; rows that share an id
never remove from one another; a null id counts as greater than all ids.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored
from shopmarts.llm.textblocks import U64, mix64, text_arrays

LENGTH = 50
GRAM = 24
WINDOWS = LENGTH - GRAM + 1  # anchors are least among so many neighbours
LEFT = LENGTH - GRAM
WIDTH = LENGTH + LEFT + 2  # a suffix, what stands before it, and the lengths of both
FINGERPRINT_BITS = 40
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
SLICE = 1 << 20
SMALL_GROUP = 10
LAST_ID = 1 << 62  # stands for a null id

COPY, SHARED, REPLY = 0, 1, 2
_REPLY = np.dtype([("suffix", "<u4"), ("low", "u1"), ("high", "u1"), ("least", "<i8")])
_NOTE = "block long, kind int, number long, data binary"


def _slide(values: np.ndarray, n: int, pick) -> np.ndarray:
    """pick over every n neighbours, by doubling."""
    step, out = 1, values
    while step * 2 <= n:
        out = pick(out[:-step], out[step:])
        step *= 2
    rest = n - step
    return pick(out[:-rest], out[rest:]) if rest else out


PRINT_SALT = U64(0xA0761D6478BD642F)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, fingerprint) of all anchors of the texts in a block, in slices of bounded size."""
    n, places, prints = len(data), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if n < LENGTH:
        return places[0], prints[0]
    for begin in range(0, n, SLICE):
        low, high = max(0, begin - WINDOWS + 1), min(n, begin + SLICE + WINDOWS - 1 + GRAM)
        part = np.zeros(high - low + 8, np.uint8)
        part[: high - low] = data[low:high]
        grams = high - low - GRAM + 1
        if grams < WINDOWS:
            continue
        eights = np.ndarray((grams + GRAM - 8,), "<u8", buffer=part, strides=(1,)) * U64(0x9E3779B97F4A7C15)
        eights ^= eights >> U64(29)
        h = eights[:grams] * U64(0xC2B2AE3D27D4EB4F)
        for at in range(8, GRAM, 8):
            h += eights[at : at + grams]
            h *= U64(0x165667B19E3779F9)
        h = mix64(h)
        rank = (h >> U64(32)).astype(np.uint32) | np.uint32(1)
        least = _slide(rank, WINDOWS, np.minimum)
        for end in offsets[np.searchsorted(offsets, low, side="right") : np.searchsorted(offsets, high + LENGTH)]:
            least[max(0, end - LENGTH + 1 - low) : max(0, end - low)] = 0  # windows that cross the end of a text
        around = np.zeros(len(least) + 2 * (WINDOWS - 1), np.uint32)
        around[WINDOWS - 1 : WINDOWS - 1 + len(least)] = least
        best = _slide(around, WINDOWS, np.maximum)
        at = np.flatnonzero((best == rank) & (best > 0))
        at = at[(at + low >= begin) & (at + low < begin + SLICE)]
        places.append(at + low)
        # an anchor has the least of many ranks, so fingerprints are scrambled anew: buckets take their top bits
        prints.append(mix64(h[at] ^ PRINT_SALT))
    return np.concatenate(places), np.concatenate(prints)


class Block:
    """The documents of one block without exact copies: bytes, ids and anchors."""

    def __init__(self, table: pa.Table, copies: set):
        order = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.data, self.offsets = text_arrays(order.column("text"))
        ids = order.column("doc_id").to_pylist()
        self.ids = ids
        self.numbers = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        # an id may stand on other texts too, so a copy is known by both
        named = {i for i, _ in copies}
        self.copy = np.array([i in named and (i, hashlib.sha256(self.data[a:b].tobytes()).hexdigest().encode()) in copies
                              for i, a, b in zip(ids, self.offsets[:-1].tolist(), self.offsets[1:].tolist())], bool)
        place, prints = anchors(self.data, self.offsets)
        row = np.searchsorted(self.offsets, place, side="right") - 1
        mine = ~self.copy[row]
        self.place, self.prints, self.row = place[mine], prints[mine], row[mine]

    def shared(self, keys: np.ndarray, bits: int) -> None:
        """Keep only anchors whose fingerprint is among the sorted keys."""
        mine = self.prints >> U64(64 - bits - FINGERPRINT_BITS)
        at = np.minimum(np.searchsorted(keys, mine), max(len(keys) - 1, 0))
        keep = keys[at] == mine if len(keys) else np.zeros(len(mine), bool)
        self.place, self.prints, self.row = self.place[keep], self.prints[keep], self.row[keep]

    def suffixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct suffixes as rows of bytes in order, suffix of each anchor, first anchor of each suffix)."""
        n = len(self.place)
        begin, end = self.offsets[self.row], self.offsets[self.row + 1]
        rows = np.zeros((n, WIDTH), np.uint8)
        columns = np.concatenate([np.arange(LENGTH), -1 - np.arange(LEFT)])
        for k in range(0, n, 1 << 16):
            some = slice(k, k + (1 << 16))
            at = self.place[some, None] + columns
            there = (at >= begin[some, None]) & (at < end[some, None])
            rows[some, : LENGTH + LEFT] = np.where(there, self.data[np.clip(at, 0, max(len(self.data) - 1, 0))], 0)
        rows[:, -2] = np.minimum(end - self.place, LENGTH)
        rows[:, -1] = np.minimum(self.place - begin, LEFT)
        _, first, which = np.unique(rows.view(f"S{WIDTH}")[:, 0] if n else np.zeros(0, f"S{WIDTH}"), return_index=True, return_inverse=True)
        return rows[first], which, first


def _five(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_PRINTS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("prints", pa.binary()), ("twice", pa.binary())])
_NOTES = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("number", pa.int64()), ("data", pa.binary())])
_RUNS = pa.schema([("bucket", pa.int64()), ("block", pa.int64()), ("common", pa.binary()), ("tails", pa.binary()), ("least", pa.binary()), ("greatest", pa.binary())])


def _copies(notes: pa.Table) -> set:
    """(id, digest) of the exact copies."""
    return {(n, d) for k, n, d in zip(*(notes.column(c).to_pylist() for c in ("kind", "number", "data"))) if k == COPY}


def _prints_of_block(bits: int):
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _table([], _PRINTS)
        block = Block(docs, _copies(notes))
        order = np.lexsort((block.numbers[block.row], block.prints))
        prints, ids = block.prints[order], block.numbers[block.row][order]
        first = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]])) if len(prints) else np.zeros(0, int)
        last = np.concatenate([first[1:], [len(prints)]]) - 1 if len(first) else first
        twice = ids[first] != ids[last]
        prints = prints[first]
        bucket = (prints >> U64(64 - bits)).astype(np.int64)
        values = (prints >> U64(64 - bits - FINGERPRINT_BITS)) & U64((1 << FINGERPRINT_BITS) - 1)
        cuts = np.searchsorted(bucket, np.unique(bucket), side="left").tolist() + [len(bucket)]
        name = docs.column("block")[0].as_py()
        return _table([(int(bucket[a]), name, _five(values[a:b]), np.packbits(twice[a:b]).tobytes()) for a, b in zip(cuts[:-1], cuts[1:])], _PRINTS)

    return run


def _shared_prints(runs: pa.Table) -> pa.Table:
    """For every block, its fingerprints that another document has too."""
    bucket = runs.column("bucket")[0].as_py()
    parts = [_from_five(x.as_py()) for x in runs.column("prints")]
    twice = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(p)).astype(bool) for x, p in zip(runs.column("twice"), parts)]
    every = np.sort(np.concatenate(parts))
    common = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for name, part, two in zip(runs.column("block").to_pylist(), parts, twice):
        at = np.minimum(np.searchsorted(common, part), max(len(common) - 1, 0))
        keep = two | (common[at] == part if len(common) else False)
        if keep.any():
            out.append((name, SHARED, bucket, _five(part[keep])))
    return _table(out, _NOTES)


def _prepared(docs: pa.Table, notes: pa.Table, bits: int):
    """The block with its shared anchors, their distinct suffixes and the bucket of each suffix."""
    block = Block(docs, _copies(notes))
    keys = [_from_five(d) | U64(n << FINGERPRINT_BITS)
            for k, n, d in zip(*(notes.column(c).to_pylist() for c in ("kind", "number", "data"))) if k == SHARED]
    block.shared(np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.uint64), bits)
    suffixes, which, first = block.suffixes()
    bucket = (block.prints[first] >> U64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")  # suffixes by bucket, in order within
    return block, suffixes, which, bucket, order


def _runs_of_block(bits: int):
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _table([], _RUNS)
        block, suffixes, which, bucket, order = _prepared(docs, notes, bits)
        ids = block.numbers[block.row]
        least, greatest = np.full(len(suffixes), LAST_ID), np.full(len(suffixes), np.iinfo(np.int64).min)
        np.minimum.at(least, which, ids)
        np.maximum.at(greatest, which, ids)
        bucket = bucket[order]
        cuts = np.searchsorted(bucket, np.unique(bucket), side="left").tolist() + [len(bucket)]
        name, out = docs.column("block")[0].as_py(), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            some = order[a:b]
            rows = suffixes[some]
            common = np.zeros(len(rows), np.uint8)
            common[1:] = (rows[1:] != rows[:-1]).argmax(axis=1)
            tails = rows[np.arange(WIDTH) >= common[:, None]].tobytes()
            out.append((int(bucket[a]), name, common.tobytes(), tails, least[some].tobytes(), (greatest[some] - least[some]).tobytes()))
        return _table(out, _RUNS)

    return run


def merge(runs: list[tuple[bytes, bytes]]):
    """Yield (suffix, common prefix with the one before, run, place in the run) of front-coded runs, in order.

    A loser tree: ``common[r]`` is the common prefix of run r's head with the last winner. Of two heads the
    one with the longer common prefix is the lesser; only if they are equal are bytes compared, from there on.
    """
    n = 1
    while n < len(runs):
        n *= 2
    heads: list = [None] * n
    common, place, at = [-1] * n, [0] * n, [0] * n

    def forward(r: int, before: bytes) -> None:
        shared, tails = runs[r]
        if place[r] == len(shared):
            heads[r], common[r] = None, -1
            return
        keep = shared[place[r]]
        begin = at[r]
        at[r] = begin + WIDTH - keep
        heads[r], common[r] = before[:keep] + tails[begin : at[r]], keep
        place[r] += 1

    for r in range(len(runs)):
        forward(r, b"")
    losers = [0] * n

    def match(x: int, y: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix is then that with the winner."""
        p, q = common[x], common[y]
        if p != q:
            return (x, y) if p > q else (y, x)
        if p < 0:
            return x, y
        a, b = heads[x], heads[y]
        if a == b:
            common[y] = WIDTH
            return x, y
        differ = int.from_bytes(a[p:], "big") ^ int.from_bytes(b[p:], "big")
        h = WIDTH - (differ.bit_length() + 7) // 8
        if a[h] < b[h]:
            common[y] = h
            return x, y
        common[x] = h
        return y, x

    def build(node: int) -> int:
        if node >= n:
            return node - n
        winner, losers[node] = match(build(2 * node), build(2 * node + 1))
        return winner

    winner = build(1)
    while heads[winner] is not None:
        head = heads[winner]
        yield head, common[winner], winner, place[winner] - 1
        forward(winner, head)
        node = (winner + n) >> 1
        while node:
            other = losers[node]
            p, q = common[winner], common[other]
            if p < q:
                losers[node], winner = winner, other
            elif p == q and p >= 0:
                winner, losers[node] = match(winner, other)
            node >>= 1


class _Suffix:
    """A distinct suffix of a group with one anchor: where it comes from, and its least document."""

    __slots__ = ("text", "common", "found", "least")

    def __init__(self, text: bytes, common: int):
        self.text, self.common, self.found, self.least = text, common, [], LAST_ID

    def offsets(self) -> tuple[int, int]:
        """Least and greatest number of bytes before the anchor in a window that fits."""
        return max(0, LENGTH - self.text[-2]), self.text[-1]


def _windows_of_few(group: list[_Suffix]) -> list[list[int]]:
    """Least document by bytes before the anchor, for each suffix; pair by pair."""
    out = [[LAST_ID] * (LEFT + 1) for _ in group]
    for i, x in enumerate(group):
        low, high = x.offsets()
        for a in range(low, high + 1):
            out[i][a] = min(out[i][a], x.least)
        after = LENGTH
        for j in range(i + 1, len(group)):
            y = group[j]
            after = min(after, y.common)
            low = LENGTH - min(after, x.text[-2], y.text[-2])
            high = min(x.text[-1], y.text[-1])
            if low > high:
                continue
            one, two = x.text[LENGTH : LENGTH + high], y.text[LENGTH : LENGTH + high]
            if one != two:
                differ = int.from_bytes(one, "big") ^ int.from_bytes(two, "big")
                high -= (differ.bit_length() + 7) // 8
            for a in range(low, high + 1):
                if x.least < out[j][a]:
                    out[j][a] = x.least
                if y.least < out[i][a]:
                    out[i][a] = y.least
    return out


def _windows_of_many(group: list[_Suffix]) -> list[list[int]]:
    """The same for a large group: one sort of the windows for each number of bytes before the anchor."""
    rows = np.frombuffer(b"".join(x.text for x in group), np.uint8).reshape(len(group), WIDTH)
    least = np.array([x.least for x in group])
    out = np.full((len(group), LEFT + 1), LAST_ID)
    for a in range(LEFT + 1):
        fit = np.flatnonzero((rows[:, -1] >= a) & (rows[:, -2] >= LENGTH - a))
        if len(fit) == 0:
            continue
        window = np.ascontiguousarray(np.concatenate([rows[fit, LENGTH : LENGTH + a], rows[fit, : LENGTH - a]], axis=1))
        _, which = np.unique(window.view(f"V{LENGTH}")[:, 0], return_inverse=True)
        best = np.full(which.max() + 1, LAST_ID)
        np.minimum.at(best, which, least[fit])
        out[fit, a] = best[which]
    return out.tolist()


def _merged_bucket(table: pa.Table) -> pa.Table:
    bucket, names = table.column("bucket")[0].as_py(), table.column("block").to_pylist()
    runs = list(zip(table.column("common").to_pylist(), table.column("tails").to_pylist()))
    least = [np.frombuffer(x, "<i8").tolist() for x in table.column("least").to_pylist()]
    spread = [np.frombuffer(x, "<i8").tolist() for x in table.column("greatest").to_pylist()]
    replies: list[list[tuple]] = [[] for _ in runs]

    def answer(group: list[_Suffix]) -> None:
        if len(group) == 1:
            x = group[0]
            low, high = x.offsets()
            if low <= high:
                for r, k in x.found:
                    if least[r][k] + spread[r][k] > x.least:
                        replies[r].append((k, low, high, x.least))
            return
        best = _windows_of_few(group) if len(group) <= SMALL_GROUP else _windows_of_many(group)
        for x, by in zip(group, best):
            a = 0
            while a <= LEFT:
                b = a
                while b < LEFT and by[b + 1] == by[a]:
                    b += 1
                if by[a] < LAST_ID:
                    for r, k in x.found:
                        if least[r][k] + spread[r][k] > by[a]:
                            replies[r].append((k, a, b, by[a]))
                a = b + 1

    group: list[_Suffix] = []
    for text, common, r, k in merge(runs):
        if common < WIDTH:
            if common < GRAM and group:
                answer(group)
                group = []
            group.append(_Suffix(text, common))
        x = group[-1]
        x.found.append((r, k))
        if least[r][k] < x.least:
            x.least = least[r][k]
    if group:
        answer(group)
    return _table([(names[r], REPLY, bucket, np.array(rows, _REPLY).tobytes()) for r, rows in enumerate(replies) if rows], _NOTES)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string())])


def _cut_block(bits: int, with_text: bool):
    def run(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            return _table([], _RESULT)
        block, suffixes, which, bucket, order = _prepared(docs, notes, bits)
        bucket = bucket[order]
        size = block.offsets[1:] - block.offsets[:-1]
        change = np.zeros(len(block.data) + 1, np.int64)
        by_suffix = np.argsort(which, kind="stable")
        begins = np.searchsorted(which[by_suffix], np.arange(len(suffixes) + 1))
        for kind, number, data in zip(*(notes.column(c).to_pylist() for c in ("kind", "number", "data"))):
            if kind != REPLY:
                continue
            reply = np.frombuffer(data, _REPLY)
            suffix = order[np.searchsorted(bucket, number) + reply["suffix"].astype(np.int64)]
            count = begins[suffix + 1] - begins[suffix]
            each = np.repeat(np.arange(len(reply)), count)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            anchor = by_suffix[begins[suffix][each] + nth]
            later = block.numbers[block.row[anchor]] > reply["least"][each]
            anchor, each = anchor[later], each[later]
            np.add.at(change, block.place[anchor] - reply["high"][each], 1)
            np.add.at(change, block.place[anchor] - reply["low"][each] + LENGTH, -1)
        gone = np.cumsum(change[:-1]) > 0
        for i in np.flatnonzero(block.copy & (size >= LENGTH)):
            gone[block.offsets[i] : block.offsets[i + 1]] = True
        out = []
        for i, doc_id in enumerate(block.ids):
            a, b = int(block.offsets[i]), int(block.offsets[i + 1])
            mine = gone[a:b]
            removed = int(mine.sum())
            kept = (block.data[a:b][~mine] if removed else block.data[a:b]).tobytes()
            spans = int(mine[0]) + int((mine[1:] & ~mine[:-1]).sum()) if removed else 0
            out.append((doc_id, b - a, removed, spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore") if with_text else None))
        return _table(out, _RESULT)

    return run


def without_repeats(docs: DataFrame, with_text: bool = False, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row, and kept_text if asked for.

    Cuts are made between bytes; kept_text leaves out characters that a cut took apart.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    digests = stored(texts.select("doc_id", F.octet_length("text").cast("long").alias("n"), F.sha2("text", 256).alias("digest")), "suffix-digests")
    total = digests.agg(F.sum("n")).first()[0] or 0
    n_blocks = int(total // block_bytes) + 1
    bits = max(1, int(total // bucket_bytes).bit_length())
    in_block = lambda spare: F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), spare)), F.lit(n_blocks))

    long_enough = digests.where((F.col("n") >= LENGTH) & F.col("doc_id").isNotNull())
    first = long_enough.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = stored(
        long_enough.join(first, "digest").where("doc_id > first_id")
        .select(in_block(F.col("doc_id")).alias("block"), F.lit(COPY).alias("kind"), F.col("doc_id").alias("number"), F.col("digest").cast("binary").alias("data")), "suffix-copies")
    dealt = texts.select(in_block(F.xxhash64("text")).alias("block"), "doc_id", "text").groupBy("block")

    prints = dealt.cogroup(copies.groupBy("block")).applyInArrow(_prints_of_block(bits), "bucket long, block long, prints binary, twice binary")
    shared = stored(prints.groupBy("bucket").applyInArrow(_shared_prints, _NOTE), "suffix-shared")
    known = copies.unionByName(shared)
    runs = dealt.cogroup(known.groupBy("block")).applyInArrow(
        _runs_of_block(bits), "bucket long, block long, common binary, tails binary, least binary, greatest binary")
    replies = runs.groupBy("bucket").applyInArrow(_merged_bucket, _NOTE)
    result = dealt.cogroup(known.unionByName(replies).groupBy("block")).applyInArrow(
        _cut_block(bits, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string")
    return result if with_text else result.drop("kept_text")

"""BPE encoding and decoding with a lexicon of frequent words in a minimal acyclic transducer.

All words of the corpus are counted, and those above the count that about ``LEXICON_WORDS`` words reach
are compiled into an acyclic automaton in which equal suffixes share their states. Its arcs carry numbers
that add up, along a word, to the word's place in a table of token ids: it transduces words to ids. States and
arcs are flat arrays in one file; Spark hands the file to every executor
(``SparkContext.addFile``), where all Python workers memory-map the same copy. All words of a block walk
through it together, one byte a step.

Words it does not know are merged exactly: pairs of neighbouring symbols are joined in order of their rank,
from a heap if the word is long, so a word of any length costs n log n. The lexicon is only a shortcut; ids
do not depend on its size or content.

The words of the lexicon are pieces of the file's splitter. Texts end at ASCII white space, over which the
normaliser (NFC, lower case) and the splitter never look; what lies between is cut into pieces byte by byte
if it is ASCII and Latin letters, and else normalised and split by the library. Decoding joins token
strings with a space, as the library does for a file without a decoder.

Defined results: a null or empty text has no ids and decodes to an empty text; strings of special tokens
in a text become their ids; repeated rows are encoded as rows of their own; an empty table has an empty
lexicon and no rows.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm.stored import stored
from shopmarts.llm.textblocks import blocks, word_bounds
from shopmarts.session import scratch_path, write_bytes

LEXICON_WORDS = 100_000
LONGEST_WORD = 48  # bytes of a word in the lexicon
SHORT_PIECE = 40  # symbols up to which a piece is merged without a heap
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the splitter of the file
REMEMBERED = 50_000  # unseen words a task remembers at a time
SLICE_WORDS = 100_000  # words or ids worked on together
BLOCK = 1 << 19  # bytes of text worked on together


# -- the exact encoder ---------------------------------------------------------------------------------


class Merger:
    """Token ids of text without ASCII white space, from the tokenizer file's own rules."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("needs a BPE file without decoder and post-processor")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must be plain strings")
        if [x["pattern"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"] != [{"Regex": PIECES}]:
            raise ValueError("needs the splitter that cells are cut by")
        tokenizer = Tokenizer.from_file(path)
        self.normalise = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        alphabet = pre_tokenizers.ByteLevel.alphabet()  # printable bytes stand for themselves, the others follow at 256
        own, others = {c for c in alphabet if ord(c) < 256}, iter(sorted(c for c in alphabet if ord(c) > 255))
        letters = [chr(b) if chr(b) in own else next(others) for b in range(256)]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + suffix] for c in letters]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.specials = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {ids[a] << 32 | ids[b]: k for k, (a, b) in enumerate(merges)}
        self.joined = [ids[a + b] for a, b in merges]
        strings = [""] * (1 + max([*ids.values(), *self.added.values()]))
        for string, i in (*ids.items(), *self.added.items()):
            strings[i] = string
        self.strings = [s.encode() for s in strings]

    def merge(self, piece: bytes) -> list[int]:
        """Join the pair of least rank, the leftmost first, until no pair has a rank."""
        ids = [self.inner[b] for b in piece]
        ids[-1] = self.last[piece[-1]]
        if len(ids) > SHORT_PIECE:
            return self._merge_long(ids)
        rank, none = self.rank, len(self.joined)
        ranks = [rank.get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            ids[k : k + 2] = [self.joined[best]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank.get(ids[k] << 32 | ids[k + 1], none)
            if k:
                ranks[k - 1] = rank.get(ids[k - 1] << 32 | ids[k], none)
        return ids

    def _merge_long(self, ids: list) -> list[int]:
        """The same with a heap of pairs and links to the neighbours: n log n."""
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank, heap = self.rank, []

        def offer(left: int, right: int) -> None:
            found = rank.get(ids[left] << 32 | ids[right])
            if found is not None:
                heapq.heappush(heap, (found, left, ids[left], ids[right]))

        for k in range(len(ids) - 1):
            offer(k, k + 1)
        while heap:
            found, left, a, b = heapq.heappop(heap)
            right = after[left]
            if ids[left] != a or right >= len(ids) or ids[right] != b:
                continue  # one of the two has been joined with another since
            ids[left], ids[right] = self.joined[found], None
            after[left] = after[right]
            if after[left] < len(ids):
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [i for i in ids if i is not None]

    def cell(self, piece: bytes) -> list[int]:
        """Ids of one cell: its characters have no decompositions left and it is one piece of the splitter."""
        return self.merge(piece if piece.isascii() else piece.decode().lower().encode())

    def __call__(self, word: str) -> list[int]:
        """Ids of any text without ASCII white space."""
        out, at = [], 0
        for found in self.specials.finditer(word):
            out += self._plain(word[at : found.start()])
            out.append(self.added[found.group()])
            at = found.end()
        return out + self._plain(word[at:])

    def _plain(self, word: str) -> list[int]:
        if not word:
            return []
        return [i for piece, _ in self.split(self.normalise(word)) for i in self.merge(bytes(map(self.byte_of.__getitem__, piece)))]


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    return Merger(path)


# -- cells -----------------------------------------------------------------------------------------------

_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _foreign(data: np.ndarray) -> np.ndarray:
    """Where characters begin that are neither ASCII nor Latin letters of U+00C0 to U+017F.

    Those letters are never composed or taken apart by the normaliser and lower-cased to letters; U+0130
    alone is not, and the two signs among them are no letters.
    """
    at = np.flatnonzero(data >= 0xC0)
    lead, trail = data[at], data[np.minimum(at + 1, len(data) - 1)]
    latin = ((lead == 0xC3) & (trail != 0x97) & (trail != 0xB7)) | ((lead == 0xC4) & (trail != 0xB0)) | (lead == 0xC5)
    return at[~latin]


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, whole): the pieces of all words in order.

    A word with other than ASCII characters and Latin letters, or with what may begin a special token, is
    one cell marked ``whole``.
    """
    n = len(data)
    word_start, word_end, word_row = word_bounds(data, offsets)
    if not len(word_start):
        return word_start, word_end, word_row, np.zeros(0, bool)
    kind, low = _KIND[data], _LOWER[data]
    fresh = np.zeros(n + 3, bool)
    fresh[word_start] = True
    starts = np.zeros(n + 3, bool)
    starts[:n] = kind == 2
    starts[1:n] |= kind[1:] != kind[:-1]
    starts |= fresh
    quote = np.flatnonzero((data == 0x27) & starts[:n])
    quote = quote[quote < n - 1]
    quote = quote[~fresh[quote + 1] & (kind[quote + 1] == 1)]
    if len(quote):  # 's 't 'm 'd, and 're 've 'll, are pieces where no sign stands before them
        padded = np.concatenate([low, np.zeros(2, np.uint8)])
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, list(b"stmd"))
        long = (((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)) & ~fresh[quote + 2]
        for found, size in ((quote[short], 2), (quote[long], 3)):
            starts[found + 1] = False
            starts[found + size] = True
    starts = starts[:n] & (kind != 0)
    stops = np.ones(n, bool)
    stops[:-1] = starts[1:] | (kind[1:] == 0)
    start, end = np.flatnonzero(starts), np.flatnonzero(stops & (kind != 0)) + 1
    word = np.cumsum(fresh[:n])[start] - 1
    odd = np.concatenate([_foreign(data), np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C))])
    whole = np.zeros(len(start), bool)
    if len(odd):
        odd_words = np.unique(np.searchsorted(word_start, odd, side="right") - 1)
        marked = np.zeros(len(word_start), bool)
        marked[odd_words] = True
        kept = ~marked[word] | fresh[start]
        start, end, word = start[kept], end[kept], word[kept]
        whole = marked[word]
        end = np.where(whole, word_end[word], end)
    return start, end, word_row[word], whole


# -- the transducer ------------------------------------------------------------------------------------


def minimal_automaton(words: list[bytes]) -> tuple[list[dict[int, int]], list[bool], int]:
    """(arcs, final, root) of the smallest acyclic automaton of sorted distinct words.

    The words come in order, so a state is complete once a word leaves its path; complete states with
    equal arcs are one.
    """
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]  # states along the last word; none of them is known yet
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            mark = (final[state], *arcs[state].items())
            twin = known.setdefault(mark, state)
            if twin != state:
                arcs[path[-1]][last[len(path) - 1]] = twin

    for word in words:
        common = next((k for k, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
        close(common)
        for byte in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][byte] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    close(0)
    return arcs, final, 0


def compiled(words: list[bytes], ids: list[list[int]]) -> bytes:
    """The transducer of sorted distinct words, and the ids of each, as one file."""
    arcs, final, root = minimal_automaton(words)
    below = [-1] * len(arcs)  # words that a state leads to

    def count(start: int) -> None:
        stack = [start]
        while stack:
            state = stack[-1]
            waiting = [t for t in arcs[state].values() if below[t] < 0]
            if waiting:
                stack += waiting
            else:
                stack.pop()
                below[state] = final[state] + sum(below[t] for t in arcs[state].values())

    count(root)
    states = [s for s in range(len(arcs)) if below[s] >= 0]
    base, at = {}, 256
    for state in states:  # a state's cells reach from its least label to its greatest
        if arcs[state]:
            base[state] = at - min(arcs[state])
            at += max(arcs[state]) - min(arcs[state]) + 1
    number = {state: k for k, state in enumerate(states)}
    size = at + 256
    owner, target, gain = np.full(size, -1, "<i4"), np.zeros(size, "<i4"), np.zeros(size, "<i4")
    for state, at in base.items():
        passed = int(final[state])
        for byte in sorted(arcs[state]):
            t = arcs[state][byte]
            owner[at + byte], target[at + byte], gain[at + byte] = number[state], number[t], passed
            passed += below[t]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype("<i4")
    parts = [np.array([base.get(s, 0) for s in states], "<i4"), np.array([final[s] for s in states], "<i4"), owner, target, gain, starts,
             np.array([i for x in ids for i in x], "<i4")]
    head = np.array([number[root], *map(len, parts)], "<i4")
    return b"".join(x.tobytes() for x in (head, *parts))


class Lexicon:
    """A compiled transducer over a buffer, a memory-mapped file as a rule."""

    def __init__(self, buffer):
        cells = np.frombuffer(buffer, "<i4")
        self.root, sizes = int(cells[0]), cells[1:8]
        cuts = 8 + np.concatenate([[0], np.cumsum(sizes)])
        self.base, self.final, self.owner, self.target, self.gain, self.starts, self.ids = (cells[a:b] for a, b in zip(cuts[:-1], cuts[1:]))

    def places(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Each word's place in the id table, -1 for words it does not know."""
        out = np.full(len(start), -1, np.int64)
        live = np.arange(len(start))
        at = start.copy()
        state = np.full(len(start), self.root, np.int32)
        place = np.zeros(len(start), np.int32)
        while len(live):
            cell = self.base[state] + data[at]
            on = self.owner[cell] == state
            cell, live, at, place = cell[on], live[on], at[on] + 1, place[on]
            state = self.target[cell]
            place += self.gain[cell]
            ended = at == end[live]
            if ended.any():
                whole = ended & (self.final[state] == 1)
                out[live[whole]] = place[whole]
                live, at, state, place = live[~ended], at[~ended], state[~ended], place[~ended]
        return out


@lru_cache(maxsize=2)
def mapped_lexicon(name: str) -> Lexicon:
    with open(SparkFiles.get(name), "rb") as f:
        return Lexicon(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every word of at most ``LONGEST_WORD`` bytes in all texts."""
    pieces = F.regexp_extract_all(F.lower("text"), F.lit(r"('(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ſ]+|[0-9]|[!-/:-@\[-`{-~]+)"), F.lit(1))
    return docs.select(F.explode(pieces).alias("word")).where(f"octet_length(word) <= {LONGEST_WORD}").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """The words above the least count that at most ``most`` words reach.

    The bound is read from a histogram of counts (one row for each sixteenth of a power of two), so
    nothing is sorted and only the words of the lexicon reach the driver.
    """
    counts = stored(word_counts(docs), "word-counts")
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    kept, bound = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True):
        if kept + row["count"] > most:
            break
        kept, bound = kept + row["count"], row["step"]
    if bound is None:
        return []
    return [r.word for r in counts.where(step >= bound).select("word").collect()]


def published_lexicon(spark: SparkSession, words: list[str], tokenizer: str) -> str:
    """Compile a lexicon, put it into the shared folder and have Spark hand it out; returns its name there."""
    exact = merger(tokenizer)
    keys = sorted(w.encode() for w in set(words))
    path = scratch_path(spark, "lexicon")
    write_bytes(spark, path, compiled(keys, [exact.cell(k) for k in keys]))
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


# -- encoding and decoding -----------------------------------------------------------------------------


def gathered(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` one after another."""
    ends = np.cumsum(lengths)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
    return pool[index]


class Encoder:
    """Ids of the words of byte blocks: the lexicon's, and merged ones for all others."""

    def __init__(self, lexicon: Lexicon, exact: Merger):
        self.lexicon, self.exact = lexicon, exact
        self.unseen: dict[bytes, np.ndarray] = {}

    def _merged(self, cell: bytes, whole: bool) -> list[int]:
        if whole:
            return self.exact(cell.decode("utf-8", "replace"))
        ids = self.unseen.get(cell)
        if ids is None:
            if len(self.unseen) >= REMEMBERED:
                self.unseen.clear()
            ids = self.exact.cell(cell)
            if len(cell) <= LONGEST_WORD:
                self.unseen[cell] = ids
        return ids

    def cells(self, data: np.ndarray, low: np.ndarray, start: np.ndarray, end: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, number of ids of each cell)."""
        lexicon, place = self.lexicon, self.lexicon.places(low, start, end)
        place[whole] = -1
        others = np.flatnonzero(place < 0)
        merged = [self._merged((data if w else low)[a:b].tobytes(), w)
                  for a, b, w in zip(start[others].tolist(), end[others].tolist(), whole[others].tolist())]
        known = np.maximum(place, 0)
        first = lexicon.starts[known].astype(np.int64)
        length = lexicon.starts[np.minimum(known + 1, len(lexicon.starts) - 1)] - first
        pool = lexicon.ids
        if merged:
            length[others] = [len(x) for x in merged]
            first[others] = len(pool) + np.cumsum(length[others]) - length[others]
            pool = np.concatenate([pool, np.array([i for x in merged for i in x], np.int32)])
        return gathered(pool, first, length), length

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, where each row's begin)."""
        start, end, row, whole = cells(data, offsets)
        low = _LOWER[data]
        parts, per_row = [np.zeros(0, np.int32)], np.zeros(len(offsets) - 1, np.int64)
        for k in range(0, len(start), SLICE_WORDS):
            cut = slice(k, k + SLICE_WORDS)
            ids, length = self.cells(data, low, start[cut], end[cut], whole[cut])
            parts.append(ids)
            per_row += np.bincount(row[cut], length, len(per_row)).astype(np.int64)
        return np.concatenate(parts).astype(np.int32), np.concatenate([[0], np.cumsum(per_row)])


class Decoder:
    """Texts of id rows: token strings with a space between them."""

    def __init__(self, strings: list[bytes]):
        spaced = [s + b" " for s in strings]
        self.pool = np.frombuffer(b"".join(spaced), np.uint8)
        self.length = np.array([len(s) for s in spaced], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def rows(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        parts = [ids[k : k + SLICE_WORDS] for k in range(0, len(ids), SLICE_WORDS)]
        text = b"".join(gathered(self.pool, self.start[x], self.length[x]).tobytes() for x in parts)
        ends = np.concatenate([[0], np.cumsum(self.length[ids])])[offsets].tolist()
        return [text[a : max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]


def coded(docs: DataFrame, tokenizer: str, decode: bool = True, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, ids (and decoded, the text that they decode to) of every row.

    ``tokenizer`` is a path that every executor can open.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    name = published_lexicon(docs.sparkSession, frequent_words(docs, lexicon_words), tokenizer)
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decode

    def run(batches):
        exact = merger(tokenizer)
        encoder, decoder = Encoder(mapped_lexicon(name), exact), Decoder(exact.strings)
        for batch in batches:
            for row, end, data, offsets in blocks(batch.column(1), BLOCK):
                ids, cuts = encoder.rows(data, offsets)
                columns = [batch.column(0)[row:end], pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids, pa.int32()))]
                if decode:
                    columns.append(pa.array(decoder.rows(ids, cuts), pa.binary()).view(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return docs.mapInArrow(run, "doc_id long, ids array<int>" + ", decoded string" * decode)


def decoded(rows: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and decoded of rows of doc_id and ids (null: no ids)."""

    def run(batches):
        decoder = Decoder(merger(tokenizer).strings)
        for batch in batches:
            lists = batch.column(1)
            cuts = np.concatenate([[0], np.cumsum([len(x) if x.is_valid else 0 for x in lists])])
            texts = decoder.rows(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), cuts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()).view(pa.string())], names=["doc_id", "decoded"])

    return rows.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, decoded string")

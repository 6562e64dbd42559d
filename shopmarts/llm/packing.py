"""Cost-balanced packing of tokenised documents into sequences.

A piece of n tokens costs n + n * n / capacity: its linear part and its attention. Documents are dealt
by hash into blocks of about ``BLOCK_CHARS`` characters. A block of T tokens gets T // capacity full
sequences and, for what is left, one sequence for every power of two in it, so nothing is padded. Whole
sequences of long documents come first; then pieces, longest first, each to the sequence of lowest cost
that still has room for it. A piece that fits nowhere is cut to fill the widest room, and the rest of it
waits its turn.

Token ids are those of the ``tokenizers`` file. Its normaliser and splitter never look across white
space, so words are encoded one by one and remembered. Words of Latin letters, digits and ASCII signs go
through a faster merge of the same vocabulary (``tiktoken``); such a result counts only if every pair of
neighbouring tokens in it is what the merge rules make of the two alone, else ``tokenizers`` decides.

Defined results: a null or empty text is the end token alone; repeated rows are packed as documents of
their own; an empty table gives no pieces.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import types
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
BLOCK_CHARS = 4_000_000
END_ID = 1
CACHED_WORDS = 400_000  # per generation, two of them
SLICE_BYTES = 16_000_000  # of text, whose distinct words are looked up together

_ODD_SPACES = "\x1c\x1d\x1e\x1f"  # white space to str.split, but not to the tokenizer
_PLAIN = re.compile("[!-~À-ÖØ-öø-įĲ-ſ]+")
_LETTERS = "a-zß-öø-ÿāăąćĉċčďđēĕėęěĝğġģĥħĩīĭįĳĵķĸĺļľŀłńņňŉŋōŏőœŕŗřśŝşšţťŧũūŭůűųŵŷźżžſ"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


def _worker_store() -> dict:
    """A dictionary that lives as long as this Python worker; tasks that share the worker share it."""
    module = sys.modules.setdefault("shopmarts_worker_store", types.ModuleType("shopmarts_worker_store"))
    return module.__dict__.setdefault("store", {})


def _byte_alphabet() -> dict[str, int]:
    """The byte of each character of the vocabulary: printable bytes are themselves, others follow at 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class WordEncoder(dict):
    """Word -> bytes of its token ids (little-endian ``dtype``).

    Words are remembered in two generations: a full dictionary becomes the older one, and words found
    there move to the new one, so common words stay and rare ones go.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary = spec["model"]["vocab"]
        self.dtype = np.dtype("<u2" if self.whole.get_vocab_size() <= 1 << 16 else "<u4")
        self.merge = None
        if spec["model"].get("end_of_word_suffix") == "</w>":
            specials = {t["content"] for t in spec["added_tokens"]}
            letters = _byte_alphabet()
            # a token as bytes, with 0xFF (never in UTF-8) for the end of a word
            ranks = {bytes(letters[c] for c in t.removesuffix("</w>")) + b"\xff" * t.endswith("</w>"): i
                     for t, i in vocabulary.items() if t not in specials}
            spare = 1 + max(vocabulary.values())
            for b in range(256):
                ranks.setdefault(bytes([b]), spare + b)
            self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
            self.token = {i: t for t, i in vocabulary.items()}
            self.rules = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): i for i, m in enumerate(spec["model"]["merges"])}
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.older: dict[str, bytes] = {}
        self.sound: set[tuple[int, int]] = set()

    def _exact(self, word: str) -> list[int]:
        return self.whole.encode(word, add_special_tokens=False).ids

    def _apart(self, a: int, b: int) -> bool:
        """Whether the merge rules, applied to the symbols of two neighbouring tokens, end at these two."""
        left, right = self.token.get(a), self.token.get(b)
        if left is None or right is None:
            return False
        end = right.endswith("</w>")
        symbols = [*left, *(right[:-4] if end else right)]
        if end:
            symbols[-1] += "</w>"
        while len(symbols) > 1:
            rank, at = min((self.rules.get(pair, len(self.rules)), i) for i, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.rules):
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols == [left, right]

    def _piece(self, piece: str) -> bytes:
        ids = self.merge(piece.encode() + b"\xff")
        if not self.sound.issuperset(pairs := list(zip(ids, ids[1:]))):
            good = {p for p in set(pairs) - self.sound if self._apart(*p)}
            self.sound |= good
            if not self.sound.issuperset(pairs):
                ids = self._exact(piece)
        return array(self.code, ids).tobytes()

    def _word(self, word: str) -> bytes:
        if not self.merge or not _PLAIN.fullmatch(word) or "<|" in word:
            return array(self.code, self._exact(word)).tobytes()
        if word.isalpha():
            return self._piece(word.lower())
        return b"".join(map(self._piece, _PIECES.findall(word.lower())))

    def __missing__(self, word: str) -> bytes:
        out = self.older.pop(word, None) or self._word(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _ODD_SPACES):
            return array(self.code, self._exact(text)).tobytes()
        return b"".join(map(self.__getitem__, text.split()))

    def encode_all(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Bytes of the token ids of each text and the end token: every distinct word is looked up once."""
        end, width = np.array([end_id], self.dtype).tobytes(), self.dtype.itemsize
        if pc.any(pc.match_substring_regex(texts, f"[{_ODD_SPACES}]")).as_py():
            return pa.array([self.encode(t) + end for t in texts.to_pylist()], pa.binary())
        words = pc.utf8_split_whitespace(texts)  # as str.split, but for empty words at the ends
        found = words.values.dictionary_encode()
        known = [*map(self.__getitem__, found.dictionary.to_pylist()), end]
        ids = np.frombuffer(b"".join(known), self.dtype)
        lengths = np.fromiter(map(len, known), np.int64, len(known)) // width
        begins = np.cumsum(lengths) - lengths
        offsets = words.offsets.to_numpy()
        # the end token is a word behind each text
        order = np.insert(found.indices.to_numpy(), offsets[1:], len(known) - 1)
        lengths, begins = lengths[order], begins[order]
        ends = np.cumsum(lengths)
        data = ids[np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1])]
        cuts = np.concatenate([[0], ends[offsets[1:] + np.arange(len(texts))]]) * width
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])


def slices(batch: pa.RecordBatch):
    """Parts of a batch (block, doc_id, text) of about ``SLICE_BYTES`` of text; none of an empty one."""
    sizes = np.cumsum(pc.binary_length(batch.column(2)).to_numpy(zero_copy_only=False), dtype=np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1).tolist(), batch.num_rows]
    return [batch[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of this file."""
    store = _worker_store()
    if path not in store:
        store[path] = WordEncoder(path)
    return store[path]


def sequence_sizes(tokens: int, capacity: int) -> list[int]:
    """Full sequences, then one for each power of two in the rest: together exactly ``tokens``."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces that fill ``sequence_sizes`` exactly."""
    sizes = sequence_sizes(sum(lengths), capacity)
    room, cost, filled = np.array(sizes, np.int64), np.zeros(len(sizes)), [0] * len(sizes)
    out = []

    def put(doc, start, n, sequence):
        out.append((doc, start, n, sequence, filled[sequence]))
        filled[sequence] += n
        room[sequence] -= n
        cost[sequence] += n + n * n / capacity

    waiting, sequence = [], 0
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= capacity:
            put(doc, start, capacity, sequence)
            sequence, start = sequence + 1, start + capacity
        if start < n:
            waiting.append((start - n, doc, start))
    heapq.heapify(waiting)
    while waiting:
        n, doc, start = heapq.heappop(waiting)
        n = -n
        best = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[best] < n:
            best = int(np.argmax(room))
            fits = int(room[best])
            heapq.heappush(waiting, (fits - n, doc, start + fits))
            n = fits
        put(doc, start, n, best)
    return out


_PIECE_FIELDS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
_SEQUENCE_BITS = 24


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is a path that every executor can open. One count of characters sets the number of blocks.
    """
    chars = docs.select(F.sum(F.length("text") + 1)).first()[0] or 0
    n_blocks = int(chars // block_chars) + 1
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)))

    def encode(batches):
        words = encoder(tokenizer)
        for batch in batches:
            for part in slices(batch):
                ids = words.encode_all(part.column(2), end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids,
                                                  pa.array([words.dtype.itemsize] * len(ids), pa.int32())], names=["block", "doc_id", "ids", "width"])

    def pack_block(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        block, width = table.column("block")[0].as_py(), table.column("width")[0].as_py()
        ids = [np.frombuffer(x.as_buffer(), f"<u{width}") for x in table.column("ids")]
        names = table.column("doc_id").to_pylist()
        rows = [
            (names[d], start, n, zlib.crc32(ids[d][start : start + n].astype("<u4").tobytes()), len(ids[d]), (block << _SEQUENCE_BITS) + s, offset)
            for d, start, n, s, offset in pack([len(x) for x in ids], capacity)
        ]
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows)], names=list(_PIECE_FIELDS))

    encoded = dealt.select("block", "doc_id", "text").mapInArrow(encode, "block long, doc_id long, ids binary, width int")
    return encoded.groupBy("block").applyInArrow(pack_block, ", ".join(f"{c} long" for c in _PIECE_FIELDS))

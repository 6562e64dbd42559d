"""Packing: every token in one place, ids as the tokenizer gives them, nothing padded."""
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shopmarts.llm import packing, queries
from tests.llm import brute

PATH = queries.public_tokenizer()


def held(rows, texts):
    """Check pieces against whole-text ids; texts: list of (doc_id, text)."""
    whole = Tokenizer.from_file(PATH)
    ids = {}
    for i, t in texts:
        ids.setdefault(i, []).append(np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        if len(ids[i]) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids[i][0]))
                assert r.ids_crc32 == zlib.crc32(ids[i][0][at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids[i][0])
        else:
            assert sum(r.length for r in pieces) == sum(map(len, ids[i]))
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == 2048 or at & (at - 1) == 0 and at < 2048


def test_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").collect()]
    held(queries.op3_packing(spark, brute.SF).collect(), texts)


def test_many_blocks(spark):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    held(packing.packed(docs, PATH, block_chars=30_000).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward(spark, table):
    docs = table(spark)
    held(packing.packed(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])


def test_words_encode_like_whole_texts():
    whole, words = Tokenizer.from_file(PATH), packing.WordEncoder(PATH)
    rng = random.Random(1)
    pieces = ["It's", "we'LL", "don't!", "'soup", "Ünïcödé", "straße", "naïve", "İstanbul", "ΣΑΣ", "日本語", "été", "12,345.67", "%%%***", "a\x1cb",
              "x\x85y", "<|endoftext|>", "<|", "🙂👍", "ﬁne", "Ⅷ", "a_b-c", " ", "\t\n", "ththnttionwh", "einübersch", "ŉ", "ĸ", "ſ", "×÷", "ª²", "﻿", "l'été"]
    for _ in range(1500):
        text = "".join(rng.choice(pieces) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randint(0, 9)))
        assert words.encode(text) == np.array(whole.encode(text, add_special_tokens=False).ids, words.dtype).tobytes(), text


def test_costs_are_balanced():
    rng = random.Random(3)
    lengths = [rng.randint(1, 900) for _ in range(3000)] + [2048 * 3 + 5, 2048]
    pieces = packing.pack(lengths)
    sizes = packing.sequence_sizes(sum(lengths), 2048)
    cost = [0.0] * len(sizes)
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 2048
    full = [c for c, n in zip(cost, sizes) if n == 2048 and c < 4096]
    assert max(full) - min(full) < 0.35 * sum(full) / len(full)
    assert len(pieces) < len(lengths) + 1.2 * len(sizes)


def test_a_column_is_encoded_word_by_distinct_word(monkeypatch):
    words = packing.WordEncoder(PATH)
    end = np.array([1], words.dtype).tobytes()
    texts = ["", "  a b\ta \n", "x\u3000y\u2028z a", "one\x1ctwo", "naïve 漢字 <|endoftext|>", "a" * 50, "b a " * 30]
    for some in (texts, [t for t in texts if "\x1c" not in t], texts[:1], texts[3:4]):
        assert words.encode_all(pa.array(some), 1).to_pylist() == [words.encode(t) + end for t in some]
    looked_up = []
    monkeypatch.setattr(packing.WordEncoder, "__getitem__", lambda self, w: looked_up.append(w) or dict.__getitem__(self, w), raising=False)
    words.encode_all(pa.array(["b a " * 30, "a b"]), 1)
    assert sorted(w for w in looked_up if w) == ["a", "b"]


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(packing, "SLICE_BYTES", 10)
    batch = pa.record_batch([pa.array(range(6)), pa.array(range(6)), pa.array(["", "x" * 35, "ab", "", "y" * 9, "z"])], names=["block", "doc_id", "text"])
    parts = packing.slices(batch)
    assert len(parts) > 1 and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert packing.slices(batch[:0]) == []

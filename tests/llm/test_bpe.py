"""BPE: ids and decoded texts as the tokenizers library gives them, whatever the lexicon."""
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from shopmarts.llm import bpe, queries
from shopmarts.llm.textblocks import word_bounds
from tests.llm import brute

PATH = queries.public_tokenizer()
WHOLE = Tokenizer.from_file(PATH)


def expected(text):
    ids = WHOLE.encode(text or "", add_special_tokens=False).ids
    return ids, WHOLE.decode(ids, skip_special_tokens=False)


def held(rows, docs):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, list(r.ids), r.decoded) for r in rows), key=key) == sorted(((i, *expected(t)) for i, t in docs), key=key)


def lexicon(words):
    exact = bpe.merger(PATH)
    keys = sorted(set(words))
    return bpe.Lexicon(bpe.compiled(keys, [exact.cell(k) for k in keys]))


def encoded(texts, words=()):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    exact = bpe.merger(PATH)
    ids, cuts = bpe.Encoder(lexicon(words), exact).rows(np.frombuffer(b"".join(data), np.uint8), offsets)
    return [ids[a:b].tolist() for a, b in zip(cuts[:-1], cuts[1:])], bpe.Decoder(exact.strings).rows(ids, cuts)


def same(texts, words=()):
    ids, decoded = encoded(texts, words)
    for text, i, d in zip(texts, ids, decoded):
        assert (i, d.decode()) == expected(text), text


def test_query(spark):
    rows = {r.doc_id: r for r in queries.op13_bpe(spark, brute.SF).collect()}
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for r in docs:
        ids, text = expected(r.text)
        assert rows[r.doc_id][1:] == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize("most", [0, 50, 5000])
def test_any_lexicon(spark, most):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    held(bpe.coded(docs, PATH, lexicon_words=most).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward(spark, table):
    docs = table(spark)
    held(bpe.coded(docs, PATH).collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert bpe.coded(docs, PATH, decode=False).columns == ["doc_id", "ids"]


def test_decoding_alone(spark):
    texts = [(1, "Some words, don't <|endoftext|> stop"), (2, ""), (3, "ünï")]
    rows = spark.createDataFrame([(i, expected(t)[0]) for i, t in texts] + [(4, None)], "doc_id long, ids array<int>")
    assert sorted(map(tuple, bpe.decoded(rows, PATH).collect())) == [*((i, expected(t)[1]) for i, t in texts), (4, "")]


def test_signs_letters_and_specials():
    same(["don't 'show 's's ''s (\"'s 'r 're 'rex 'll 'l' ' '", "x'S 'LL 'Ve' y'1's", "<|endoftext|>a<|startoftext|><|endoftext|> <| endoftext|> a<|b",
          "ÀÉß×÷ İstanbul İ, ŉ ſ Ÿ À̂ é≠ ≮a 'ś 's̀", "日本語。テキスト　です", "“quoted’s” — naïve…", "a\x1cb\x1fc\x85d\xa0e f", "1234 ½ ٣ x²", "é ́x ㎏ ﬁ", "Σ ΑΣ ς",
          "\x00\x01\x7f", "👩‍👩‍👧 🤦🏼", "x" * 3000, "ab" * 40 + "é" * 100, "", " ", "'"], [b"don", b"'t", b"x", b"the"])


PIECES = ["'", "s", "'s", "'ll", "re", "É", "é", "ß", "İ", "̇", "́", "=", "̸", "1", "٣", "<|", "<|endoftext|>", "|>", " ", "\n", "\x1c", "\xa0", "　", "日", "“", "×", "ſ", "a", "B", "the", ",", "…", "😀"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=14).map("".join), max_size=6), st.lists(st.sampled_from([b"the", b"s", b"'s", b"a", b",", "é".encode()])))
def test_mixed_pieces(texts, words):
    same(texts, words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_text(texts):
    same(texts)


def test_short_and_long_merges_agree():
    exact, rng = bpe.merger(PATH), random.Random(2)
    for _ in range(300):
        piece = "".join(rng.choices("abcdeinorst", k=rng.randrange(1, 60))).encode()
        ids = [exact.inner[b] for b in piece]
        ids[-1] = exact.last[piece[-1]]
        assert exact.merge(piece) == exact._merge_long(ids) == expected(piece.decode())[0]


def test_transducer_is_minimal_and_complete():
    rng = random.Random(7)
    words = sorted({"".join(rng.choices("abcd", k=rng.randrange(1, 9))).encode() for _ in range(600)} | {"é".encode(), b"\xff", b"zzz"})
    arcs, final, root = bpe.minimal_automaton(words)
    reached, queue = {root}, [root]
    while queue:
        for t in arcs[queue.pop()].values():
            if t not in reached:
                reached.add(t)
                queue.append(t)
    suffixes = {w[:k]: None for w in words for k in range(len(w) + 1)}
    for prefix in suffixes:
        suffixes[prefix] = frozenset(w[len(prefix) :] for w in words if w.startswith(prefix))
    assert len(reached) == len(set(suffixes.values()))  # one state for each different set of suffixes
    table = bpe.Lexicon(bpe.compiled(words, [[k, k + 1] for k in range(len(words))]))
    asked = [*words, b"abcdabcdabcd", b"e", b"zz", b"zzzz", b"a\x00"]
    data = np.frombuffer(b" ".join(asked), np.uint8)
    start, end, _ = word_bounds(data, np.array([0, len(data)]))
    known = {w: k for k, w in enumerate(words)}
    assert table.places(data, start, end).tolist() == [known.get(w, -1) for w in asked]
    assert [table.ids[table.starts[k] : table.starts[k + 1]].tolist() for k in range(len(words))] == [[k, k + 1] for k in range(len(words))]


def test_words_of_the_lexicon(spark):
    rows = [(k, f"w{'x' * k} " * (k + 1)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert bpe.frequent_words(docs, 0) == []
    few = bpe.frequent_words(docs, 10)
    assert 0 < len(few) <= 10 and "w" + "x" * 29 in few
    assert len(bpe.frequent_words(docs, 1000)) == 30

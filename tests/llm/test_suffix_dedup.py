"""Removal of repeated strings against a dictionary of all 50-byte strings."""
import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shopmarts.llm import queries, suffix_dedup
from shopmarts.llm.textblocks import text_arrays
from tests.llm import brute

N = suffix_dedup.LENGTH


def reference(rows):
    """(n_bytes, n_removed, n_spans, sha) per row, in order of rows."""
    data = [(i if i is not None else suffix_dedup.LAST_ID, (t or "").encode()) for i, t in rows]
    least = {}
    for i, b in data:
        for k in range(len(b) - N + 1):
            s = b[k : k + N]
            least[s] = min(i, least.get(s, i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - N + 1):
            if least[b[k : k + N]] < i:
                gone[k : k + N] = b"\x01" * N
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def expected(rows):
    return sorted((i is None, i or 0, *x) for (i, _), x in zip(rows, reference(rows)))


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{brute.SF}/documents.parquet").collect()]
    got = result(queries.op1_suffix_dedup(spark, brute.SF))
    assert got == expected(rows)
    assert sum(r[3] for r in got) > 0


def test_planted_passages_in_many_blocks(spark):
    rng = random.Random(9)
    text = lambda n, letters="abcdefgh ": "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 60, 75, 76, 77, 120, 400)] + ["ab" * 60, "z" * 130, "é" * 40]
    rows = []
    for i in range(160):
        parts = [text(rng.randint(0, 90)) for _ in range(3)]
        for s in rng.sample(shared, 4):
            cut = rng.randint(0, 12)
            parts.insert(rng.randint(0, len(parts)), s[cut:])
        rows.append((rng.choice([i, i, i, i % 7]), "".join(parts)))
    rows += [(None, rows[3][1]), (500, rows[5][1]), (501, rows[5][1]), (502, None), (503, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix_dedup.without_repeats(df, block_bytes=2000, bucket_bytes=4000)) == expected(rows)


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward(spark, table):
    docs = table(spark)
    got = result(suffix_dedup.without_repeats(docs))
    assert len(got) == docs.count()
    small = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 6000]
    assert result(suffix_dedup.without_repeats(docs.where("length(coalesce(text, '')) < 6000"))) == expected(small)


def test_an_id_on_a_copy_and_on_a_text_of_its_own(spark):
    copied, own = "the very same words again and " * 4, "nobody else has written this line, not even 0123456789 in part"
    rows = [(1, copied), (2, copied), (2, own), (3, own + " but more")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(suffix_dedup.without_repeats(df)) == expected(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.text("ab\0", max_size=5).map(str.encode), max_size=8), min_size=1, max_size=9))
def test_loser_tree_merges_front_coded_runs(parts):
    width = suffix_dedup.WIDTH
    runs, plain = [], []
    for part in parts:
        rows = sorted({p.ljust(width, b"\0") for p in part})
        common, tails = [], b""
        for k, row in enumerate(rows):
            c = 0
            while k and row[c] == rows[k - 1][c]:
                c += 1
            common.append(c)
            tails += row[c:]
        runs.append((bytes(common), tails))
        plain += rows
    got = list(suffix_dedup.merge(runs))
    assert [g[0] for g in got] == sorted(plain)
    for before, after in zip(got, got[1:]):
        same = next((k for k in range(width) if before[0][k] != after[0][k]), width)
        assert after[1] == same


def test_few_and_many_agree():
    rng = random.Random(4)
    base = bytes(rng.randrange(97, 100) for _ in range(200))
    rows = set()
    for _ in range(30):
        right = rng.choice([50, 50, 40, 30, 24])
        left = rng.choice([26, 26, 10, 0])
        body = bytearray(base[:24] + bytes(rng.choice(b"xy") if rng.random() < 0.1 else c for c in base[24:right]))
        back = bytearray(rng.choice(b"xy") if rng.random() < 0.1 else c for c in base[60 : 60 + left])
        rows.add(bytes(body).ljust(50, b"\0") + bytes(back).ljust(26, b"\0") + bytes([right, left]))
    group, before = [], None
    for k, text in enumerate(sorted(rows)):
        common = next((i for i in range(len(text)) if before is None or text[i] != before[i]), len(text))
        x = suffix_dedup._Suffix(text, common)
        x.least = rng.randrange(100)
        group.append(x)
        before = text
    assert suffix_dedup._windows_of_few(group) == suffix_dedup._windows_of_many(group)


def test_buckets_are_even():
    """Anchors are chosen by small ranks; their buckets must not show it."""
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])
    data, offsets = text_arrays(table.column("text"))
    _, prints = suffix_dedup.anchors(data, offsets)
    sizes = np.bincount((np.unique(prints) >> np.uint64(58)).astype(np.int64), minlength=64)
    assert sizes.sum() > 10_000 and sizes.max() <= 2 * sizes.mean() and sizes.min() >= sizes.mean() / 2

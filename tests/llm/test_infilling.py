"""Fill-in-the-middle against a plain restatement, over code points, words and lines."""
import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmarts.llm import infilling, queries
from tests.llm import brute

UNITS = {"code_point": r"(?s:.)", "line": r"[^\n]*\n|[^\n]+"}


def units_of(text, unit):
    """Units tile the text: words take the white space after them, and the first also what stands before it."""
    if unit == "word":
        return [x for x in re.findall(r"^[\x20\x09-\x0D]+|[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text) if x]
    return [x for x in re.findall(UNITS[unit], text) if x]


def restated(doc_id, text, unit="code_point"):
    text = text or ""
    units = units_of(text, unit)
    n = len(units)
    key = hashlib.sha256(f"1:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(key[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def held(rows, docs, unit="code_point"):
    expected = sorted(((i, *restated(i, t, unit)) for i, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[5]))
    got = sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[5]))
    assert got == expected


@pytest.mark.parametrize("unit", infilling.UNITS)
@pytest.mark.parametrize("block_bytes", [1, 7, 4096])
def test_whole_table(spark, unit, block_bytes):
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    frame = infilling.infilled(docs, unit, block_bytes=block_bytes)
    held(frame.collect(), [(r.doc_id, r.text) for r in docs.collect()], unit)
    changed = frame.select(infilling.restored(F.col("output"), F.col("form")).alias("back"), "doc_id").join(docs, "doc_id").where("not (back <=> coalesce(text, ''))")
    assert changed.isEmpty()


def test_query_and_sql(spark):
    got = queries.op11_infilling(spark, brute.SF)
    with duckdb.connect() as con:
        con.sql(f"create view documents as select * from '{brute.SF}/documents.parquet'")
        expected = con.sql(queries.OP11_SQL)
        assert got.columns == expected.columns
        rows = sorted(expected.fetchall())
    assert sorted(map(tuple, got.collect())) == rows
    assert {r[2] for r in rows} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
@pytest.mark.parametrize("unit", infilling.UNITS)
def test_awkward(spark, table, unit):
    docs = table(spark)
    held(infilling.infilled(docs, unit).collect(), [(r.doc_id, r.text) for r in docs.collect()], unit)


def test_markers_and_their_beginnings(spark):
    parts = ["<", "<P", "<S", "<M", ">", "S>", "é", "𝄞", "<P>", "<S>", "<M>", " ", "\n"]
    random.seed(5)
    docs = [(i, "".join(random.choices(parts, [9] * 8 + [1] * 3 + [3] * 2, k=random.randrange(12)))) for i in range(1500)]
    frame = infilling.infilled(spark.createDataFrame(docs, "doc_id long, text string"))
    held(frame.collect(), docs)
    back = frame.select("doc_id", infilling.restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back)) == docs


def test_descent_finds_every_unit():
    rng = np.random.default_rng(3)
    for blocks in (1, 2, 3, 8, 13, 64):
        counts = rng.integers(0, 4, size=(blocks, 2))
        counts[-1, 0] += 1
        tree = infilling.Fenwick(counts)
        assert tree.total == counts.sum(axis=0).tolist()
        before = np.concatenate([[[0, 0]], np.cumsum(counts, axis=0)])
        for unit in range(tree.total[0]):
            at = int(np.searchsorted(before[:, 0], unit, side="right")) - 1
            assert tree.descend(unit) == (at, before[at].tolist())


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        infilling.infilled(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "sentence")

"""The mix against its SQL, and its promises on awkward tables."""
import duckdb
import pytest
from pyspark.sql import functions as F

from shopmarts.llm import mixing, queries
from tests.llm import brute


def reference_targets(sizes, weights=(1, 2, 3), most=3):
    """Share, stop at the limit, share the excess again, until none is above."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        level = left / sum(weight[n] for n in open_)
        over = {n for n in open_ if level * weight[n] > most * sizes[n]}
        for n in over or open_:
            target[n] = float(most * sizes[n]) if over else level * weight[n]
        left -= sum(target[n] for n in over)
        open_ = open_ - over if over else set()
    return target


def test_targets_are_reshared(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "é": 3000, None: 40, "z": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = reference_targets(sizes)
    assert got == pytest.approx(want)


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_mix_awkward(spark, table):
    docs = table(spark)
    rows = mixing.mixture(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0 for r in rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert out.where(mixing.size_column(F.col("text")) > 0).count() == sum(r.taken // r.size for r in rows if r.size)


def test_documents_without_words_are_not_taken_too_often(spark):
    """A source far below its target is taken three times; its empty texts must not come a fourth time."""
    rows = [(k, "a" if k < 400 else "b", "" if k % 4 == 0 else "word " * (1 if k < 400 else 50)) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    counts = {r.doc_id: r["count"] for r in mixing.mixed_documents(docs, weights=(9, 1)).groupBy("doc_id").count().collect()}
    assert max(counts.values()) == 3 and all(counts[k] == 3 for k in range(400))


def test_mix_comes_near_and_is_repeatable(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one = mixing.mixture(docs).collect()
    two = mixing.mixture(docs.repartition(13)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    largest = max(r.size for r in one)
    by = {}
    for r in one:
        by.setdefault((r.source, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) <= largest for (_, t), v in by.items())


def test_query_matches_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{brute.SF}/documents.parquet')")
    want = con.execute(queries.ORACLES["op6_source_mixing"]).fetchall()
    got = [tuple(r) for r in queries.op6_source_mixing(spark, brute.SF).collect()]
    assert sorted(got) == [(a, b, c, pytest.approx(d), e) for a, b, c, d, e in sorted(want)]

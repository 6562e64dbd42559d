"""Near-duplicates against all pairs of full shingle sets."""
import random

import numpy as np
import pytest

from shopmarts.llm import near_dedup, queries
from shopmarts.llm.components import components
from tests.llm import brute


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = brute.WORD.findall(low)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[k:] for k in range(5))))


def reference(rows):
    """{row index: (n, component)}; unions of all linked pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < i}:
            if root(i) != root(j) and 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                parent[root(i)] = root(j)
    first = {}
    for i, (doc, _) in enumerate(rows):  # an id is one document
        if doc is not None and sets[i]:
            parent[root(i)] = root(first.setdefault(doc, i))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def test_query(spark):
    path = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    df = queries.op2_near_duplicates(spark, path)
    assert result(df) == sorted(reference(rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in df.collect())


def test_chains_and_crowded_buckets(spark):
    """Copies whose similarity lies about the threshold, where a bucket's smallest id misses many links."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    rows = []
    for family in range(4):
        base = rng.sample(words, 120)
        for _ in range(60):
            text = list(base)
            for _ in range(rng.randint(0, 7)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows) * 3 % 1000 + 7, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_dedup.near_duplicates(df)) == sorted(reference(rows), key=str)


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward(spark, table):
    docs = table(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(near_dedup.near_duplicates(docs)) == sorted(reference(rows), key=str)
    kept = near_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(doc == c for doc, _, c in reference(rows))


def test_one_id_with_several_texts(spark):
    a, b = ([f"{c}{k}" for k in range(60)] for c in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a + ["x"])), (3, " ".join(b + ["y"])), (5, " ".join(b)), (5, "c " * 9), (4, "c " * 9),
            (1, None), (7, " ".join(a[:30])), (7, ""), (None, " ".join(b)), (None, "d e f"), (None, "d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = result(near_dedup.near_duplicates(df))
    assert got == sorted(reference(rows), key=str)
    assert {c for d, n, c in got if d in (1, 2, 3, 4, 5) and n} == {1}
    assert sorted(r.doc_id for r in near_dedup.distinct_documents(df).collect() if r.doc_id) == [1, 1, 1, 7, 7]


def _classes(sets):
    """Sets of numbers as the frames that the second round reads."""
    shingles = [(i, np.array(sorted(x), "<u8").tobytes()) for i, x in enumerate(sets)]
    return shingles, [(i, len(x), i, i % 3 != 0) for i, x in enumerate(sets)]


def test_prefix_index_meets_every_link_and_few_others(spark):
    rng = random.Random(4)
    base, sets = list(range(1, 201)), []
    for k in range(150):  # a family around the threshold, sizes from 150 to 260
        x = set(rng.sample(base, rng.randrange(150, 200))) | {1000 + 100 * k + j for j in range(rng.randrange(60))}
        sets.append(x)
    sets += [set(rng.sample(range(10_000), rng.randrange(1, 40))) for _ in range(60)] + [{1}, {1, 2}, {1, 2, 3, 4}, {1, 2, 3}]
    shingles, classes = _classes(sets)
    index = near_dedup._prefix_index(spark.createDataFrame(shingles, "id long, shingles binary"),
                                     spark.createDataFrame(classes, "id long, n long, component long, minor boolean"))
    got = {(r.a, r.b) for r in near_dedup._prefix_pairs(index).collect()}
    pairs = [(a, b) for b in range(len(sets)) for a in range(b) if a % 3 or b % 3]
    links = {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert len(links) > 200 and links <= got


def test_copies_below_the_threshold_do_not_meet(spark):
    """Each text of the family differs from the base in a sixth of its shingles: no two of them link or meet."""
    sets = [set(range(1000)) - set(range(k, 1000, 6)) | {10_000 * (k + 1) + j for j in range(167)} for k in range(6)]
    sets += [set(range(1000)) - {(7 * k + 6 * j) % 1000 for j in range(167)} | {10_000 * (k + 10) + j for j in range(170)} for k in range(200)]
    shingles, classes = _classes(sets)
    index = near_dedup._prefix_index(spark.createDataFrame(shingles, "id long, shingles binary"),
                                     spark.createDataFrame(classes, "id long, n long, component long, minor boolean"))
    assert near_dedup._prefix_pairs(index).count() < len(sets)


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.6, 0.75, 0.9, 1.0):
        n = 2000
        common = int(2 * n * share / (1 + share))
        pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
        a, b = pool[:n], pool[n - common : 2 * n - common]
        r = near_dedup.registers(np.concatenate([a, b]), np.array([0, n]))
        got = near_dedup.jaccard_estimates(r[:1], r[1:], np.array([n]), np.array([n]))[0]
        assert abs(got - share) < 0.17


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(130, 50)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and {got[i] for i in range(100, 160)} == {50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_miss_few_pairs_at_the_threshold():
    """The bands share registers, so their miss is simulated: 200,000 pairs that agree in 75 % of them."""
    rng = np.random.default_rng(1)
    bands, missed = near_dedup._BANDED.reshape(near_dedup.BANDS, near_dedup.ROWS), 0
    for _ in range(20):
        agree = rng.random((10_000, near_dedup.REGISTERS), dtype=np.float32) < 0.75
        apart = np.arange(len(agree))
        for band in bands:
            apart = apart[~agree[apart][:, band].all(axis=1)]
        missed += len(apart)
    assert missed <= 5

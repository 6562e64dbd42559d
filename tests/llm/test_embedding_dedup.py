"""Near vectors against all pairs in double precision."""
import numpy as np

from shopmarts.llm import embedding_dedup, queries


def reference(rows, least=0.93):
    """{(a, b)} of linked row indices."""
    out = set()
    by = {}
    for i, (_, v, label) in enumerate(rows):
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        by.setdefault((label, len(v)), []).append(i)
    for some in by.values():
        x = np.array([rows[i][1] for i in some], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = np.nonzero(x @ x.T >= least)
        out |= {(some[i], some[j]) for i, j in zip(a, b) if i < j}
    return out


def components(rows, links):
    ids = [r[0] for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[root(a)] = root(b)
    least = {}
    for i, n in enumerate(ids):
        least[root(i)] = min(n, least.get(root(i), n))
    return [least[root(i)] for i in range(len(rows))]


def test_query_finds_the_links(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()]
    links = reference(rows)
    n_links = np.bincount(np.array(sorted(links)).reshape(-1), minlength=len(rows)) if links else np.zeros(len(rows), int)
    got = {r.vec_id: r for r in queries.op7_near_embeddings(spark, path).collect()}
    found = sum(got[r[0]].n_links for r in rows) / 2
    assert all(got[r[0]].n_links <= n for r, n in zip(rows, n_links)) and found >= 0.98 * len(links)
    want = components(rows, links)
    assert sum(got[r[0]].component_id == c for r, c in zip(rows, want)) >= 0.99 * len(rows)


def test_awkward_and_crowded(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    rows = [(i, (base + 0.02 * rng.normal(size=16)).tolist(), 1) for i in range(600)]  # more than two blocks
    rows += [(1000, base.tolist(), 2), (1001, base.tolist(), 2), (1001, base.tolist(), 2), (1002, (base * 3).tolist(), 2), (1003, None, 2), (1004, [0.0] * 16, 2),
             (1005, base.tolist(), None), (1006, [None, *base.tolist()[1:]], 2), (1007, [float("nan")] * 16, 2), (1008, [], 2), (1009, base.tolist()[:8], 2),
             (1010, [float("inf")] * 16, 2), (1011, (base * 1e300).tolist(), 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "7 as a", "7 as id", "7 as name")
    links = reference(rows)
    count = np.bincount(np.array(sorted(links)).reshape(-1), minlength=len(rows))
    want = sorted(zip([r[0] for r in rows], count.tolist(), components(rows, links)))
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.near_vectors(df).collect())
    assert got == want
    assert embedding_dedup.near_vectors(df.where("false")).count() == 0


def test_planted_pairs_share_a_filter_at_every_size():
    for n_vectors in (10**3, 10**4, 10**5, 10**6, 10**7, 10**8):
        code = embedding_dedup.ProductCode(64, n_vectors)
        for cosine in (0.93, 0.95):
            met = 0
            for k in range(4):
                sides = embedding_dedup.planted_pairs(64, cosine, 250, 100 + k)
                caught = [code.decode(x) for x in sides]
                assert all(set(row.tolist()) == set(range(250)) for row, _ in caught)
                pairs = [set(zip(row.tolist(), filter_.tolist())) for row, filter_ in caught]
                met += len({row for row, _ in pairs[0] & pairs[1]})
            assert met >= 0.98 * 1000, (n_vectors, cosine, met)


def test_planted_links_are_found_among_many_vectors(spark):
    """Recall against brute force over a table that does have links, also with codes made for larger tables."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 64))
    for cosine in (0.931, 0.95, 0.98):
        x = np.concatenate([x, *embedding_dedup.planted_pairs(64, cosine, 200, int(1000 * cosine))])
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    want = reference(rows)
    assert len(want) >= 600
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in embedding_dedup.near_vectors(df).collect()) / 2
    assert 0.98 * len(want) <= found <= len(want)
    classes = embedding_dedup._vectors(df).withColumnRenamed("vec_id", "id").select("id", "label", "length", "vector").cache()
    for n_vectors in (10**6, 10**8):
        got = {(r.a, r.b) for r in embedding_dedup.links(classes, n_vectors).collect()}
        assert got <= want and len(got) >= 0.98 * len(want), n_vectors
    classes.unpersist()

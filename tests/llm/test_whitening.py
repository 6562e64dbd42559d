"""Whitening against numpy on whole tables, and odd vectors."""
import math

import numpy as np
import pytest

from shopmarts.llm import queries, whitening
from tests.llm import brute

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def brute_force(vectors, components=4):
    """{position: rows} of whole vectors, and the fit's directions."""
    whole = {i: v for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    d = max(map(len, whole.values()))
    x = {i: [math.floor(256 * float(c)) for c in v] + [0] * (d - len(v)) for i, v in whole.items()}
    fit = np.array(sorted(set(map(tuple, x.values()))), float)
    n = len(fit)
    sums = [sum(int(r[k]) for r in fit) for k in range(d)]
    centred = fit - np.array([s / n for s in sums])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:components]
    out = {}
    for i, row in x.items():
        deviation = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        away = np.array(row) - np.array([s / n for s in sums])
        out[i] = (n, deviation, [(away @ v[:, k] / math.sqrt(e[k]), e[k] / e.sum()) if e[k] > 1e-9 * e.max() else (None, e[k]) for k in order])
    return out


def held(rows, ids, vectors, components=4):
    expected = brute_force(vectors, components)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(by_id) == len({ids[i] for i in expected})
    signs = {}
    for i, (n, deviation, parts) in expected.items():
        got = sorted((r for r in by_id[ids[i]] if r.deviation == deviation), key=lambda r: r.component)
        assert [r.component for r in got[:: max(1, len(got) // len(parts))]] == list(range(1, len(parts) + 1))
        for r in got:
            value, share = parts[r.component - 1]
            assert r.n == n
            if value is None:
                assert r.whitened is None
                continue
            assert abs(r.explained - share) <= 1e-4 * share and r.identity_error <= 1e-4
            if abs(value) > 1e-3:
                sign = signs.setdefault(r.component, np.sign(value * r.whitened))
                assert abs(r.whitened * sign - value) < 1e-6 * max(1, abs(value))


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_query(spark):
    rows = spark.read.parquet(f"{brute.SF}/embeddings.parquet").collect()
    got = queries.op12_whitening(spark, brute.SF)
    assert got.columns == COLUMNS
    held(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "LEAST_BLOCK_BYTES", 64 * 10)
    monkeypatch.setattr(whitening, "BLOCKS", 1 << 40)
    monkeypatch.setattr(whitening, "TASK_BYTES", 4096)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(300, 6)) * [5, 4, 3, 2, 1, 1]).tolist()
    vectors += [vectors[0]] * 150  # one group of copies holds a third of the rows
    held(whitening.whitened(table(spark, list(enumerate(vectors))).repartition(7)).collect(), list(range(450)), vectors)


def test_awkward(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [1.0, None, 2.0], [nan, 1.0, 1.0], [inf, 0.0, 0.0], [1.0, 2.0, 3.0], [1.0, 2.0, 3.0], [0.5, -1.0, 2.0], [3.0, 1.0, -2.0],
               [1.0], [], [-0.0, 0.001, 7.0], [2.0, -3.0, 0.25]]
    ids = [0, 1, 2, 3, 4, 4, 5, 6, 7, 8, None, 9]
    df = table(spark, list(zip(ids, vectors))).selectExpr("*", "7 as row", "7 as id", "7 as x", "7 as n", "7 as component", "7 as part", "7 as mark")
    got = whitening.whitened(df)
    assert got.columns == COLUMNS
    held(got.collect(), ids, vectors)


@pytest.mark.parametrize("vectors, components", [([], 0), ([None, [float("nan")]], 0), ([[]], 0), ([[1.0, 2.0]], 2), ([[1.0, 2.0], [1.0, 2.0]], 2), ([[1.0, 5.0], [2.0, 5.0]], 2)])
def test_little_variance(spark, vectors, components):
    rows = whitening.whitened(table(spark, list(enumerate(vectors)))).collect()
    assert len(rows) == components * sum(bool(v) and v[0] == v[0] for v in vectors)
    for r in rows:
        live = len({tuple(v) for v in vectors}) > 1 and r.component == 1
        assert (r.whitened is not None) == live and (r.identity_error is None) == (len({tuple(v) for v in vectors}) == 1)


def test_exact_beyond_doubles(spark):
    vectors = [[2.0**20 + k / 256, -float(k)] for k in range(40)] + [[1e300, 0.0]]
    got = {r.vec_id: r.deviation for r in whitening.whitened(table(spark, list(enumerate(vectors[:-1])))).collect()}
    expected = brute_force(vectors[:-1])
    assert got == {i: d for i, (_, d, _) in expected.items()}
    assert all(r.deviation is None for r in whitening.whitened(table(spark, list(enumerate(vectors)))).collect())

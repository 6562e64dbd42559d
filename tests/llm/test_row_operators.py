"""Operators that look at one text at a time, against plain restatements."""
import random
from collections import Counter

import pytest

from shopmarts.llm import pii, quality, queries
from tests.llm import brute


def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{brute.SF}/documents.parquet").collect()}


def test_quality_base_counts(spark):
    source = texts(spark)
    for r in queries.op4_quality_rules(spark, brute.SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality_base(source[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_quality_follows_the_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op4_quality_rules(spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id] == 1]
    bad = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.35 * len(bad)


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_quality_awkward(spark, table):
    docs = table(spark)
    labels = spark.read.parquet(f"{brute.SF}/labels.parquet")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality.quality(docs, labels).collect())
    assert got == Counter((r.doc_id, *brute.quality_base(r.text)) for r in docs.collect())
    kept = quality.good_documents(docs, labels.where("false"))
    assert kept.schema == docs.schema
    assert kept.count() == sum(not brute.quality_base(r.text)[-1] for r in docs.collect())


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np

    rng = np.random.default_rng(3)
    field = quality.LineField(rng.normal(size=len(quality.FEATURES)), rng.normal(size=(2, 2)))
    for n in range(1, 8):
        x = rng.normal(size=(n, len(quality.FEATURES)))
        s = x @ field.weights
        value = lambda y: sum(s[i] * y[i] for i in range(n)) + sum(field.moves[a][b] for a, b in zip(y, y[1:]))  # noqa: B023,E731
        best = max(itertools.product((0, 1), repeat=n), key=value)
        assert value(field.decode(x, np.zeros(n, int)).astype(int)) == pytest.approx(value(best))


def test_base_spans_match_the_patterns(spark):
    for r in queries.op9_personal_data(spark, "/root/testdata/sf0.01").collect():
        pass
    rng = random.Random(5)
    pieces = ["a@b.c", "@", ".", "..", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (555) 010-9999",
              "+", "++1 2", " ", "-", "x", "é", "12", "a.b@c-d.e.f", "%", "\n", "0000000000000000", "1.2.3.4.5.6.7.8", "(", ")"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert sorted(pii.base_spans(text)) == sorted(brute.base_spans(text)), text


def test_personal_data_query(spark):
    source = texts(spark)
    for r in queries.op9_personal_data(spark, brute.SF).collect():
        spans = brute.base_spans(source[r.doc_id])
        assert r.base_sha256 == brute.spans_digest(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == s[0] for s in spans) for k in pii.BASE_KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r.spans.split(",")) | {""}


def test_further_kinds_need_check_or_context():
    kinds = lambda t: [k for k, _, _ in pii.find(t)[1]]
    assert kinds("transfer to DE89 3704 0044 0532 0130 00 today") == ["iban"]
    assert kinds("transfer to DE89 3704 0044 0532 0130 01 today") == []
    assert kinds("her ssn is 123-45-6789") == ["ssn"] and kinds("part 123-45-6789") == []
    assert kinds("call 555-010-9999 now") == ["phone"] and kinds("code 555-010-9999 now") == []
    assert pii.redact("write a@b.org or call +49 30 1234567.") == "write <EMAIL> or call <PHONE>."


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_personal_data_awkward(spark, table):
    docs = table(spark)
    got = Counter((r.doc_id, r.base_sha256) for r in pii.personal_data(docs).collect())
    assert got == Counter((r.doc_id, brute.spans_digest(brute.base_spans(r.text if len(r.text or "") < 9000 else r.text[:9000]))) for r in docs.collect())
    out = pii.redacted_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count()

"""Held-out accuracy of the fitted models, and their defined results."""
import random

import numpy as np
import pyarrow as pa
import pytest

from shopmarts.llm import langid, quality, queries, sampling, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.1"


def test_language_on_the_test_fold(spark):
    lang = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in queries.op10_language(spark, SF).collect()]
    held = [r for r in rows if r.held_out and lang[r.doc_id][0]]
    assert sum(r.lang_pred == lang[r.doc_id][0] for r in held) >= 0.98 * len(held)
    assert 0.15 < len(held) / len(rows) < 0.25 and all(0 <= r.score <= 1 for r in rows)


def test_toxicity_on_the_test_fold(spark):
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(r.predicted, toxic[r.doc_id]) for r in queries.op5_toxicity(spark, SF).collect() if r.held_out and r.doc_id in toxic]
    hit = sum(p == y == 1 for p, y in held)
    assert hit >= 0.9 * sum(y for _, y in held) and hit >= 0.95 * sum(p for p, _ in held)


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward(spark, table):
    docs = table(spark)
    train = spark.read.parquet(f"{brute.SF}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SF}/labels.parquet")
    model = langid.fit_language_model(train, 40)
    rows = langid.languages(docs, model).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        lettered = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not lettered) and (r.held_out or r.doc_id is not None)
    scored = toxicity.toxicity(docs, labels, toxicity.fit_lexicon(train, labels, 200)).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scored)
    nothing = toxicity.toxicity(docs, labels.where("false")).collect()
    assert all(r.score == 0 for r in nothing)
    assert {r.lang_pred for r in langid.languages(docs.where("lang is null")).collect()} <= {"und"}


def test_folding_and_exceptions():
    words = toxicity.folded_words
    assert words("ІDІОТ 1d10t idi​ot $cum Ｓｃｕｍ") == ["idiot", "idiot", "idiot", "scum", "scum"]
    assert words("in 1984, 300 people $$$ wow!!") == ["in", "people", "wow"]
    lexicon = toxicity.Lexicon({" clown ": 5.0, " moro": 4.0}, {" clown fish "}, (2.0, 0.0, -2.0))
    found = lambda t: len(lexicon.found(lexicon.matcher(), toxicity._line(words(t))))
    assert found("you cl0wn and moronic clowns") == 2 and found("a clown fish swims") == 0 and found("clown fish clown") == 1
    assert lexicon.score(5.0, 10) > 0.5 > lexicon.score(0.0, 10)


def _labelled(spark, sf="/root/testdata/sf0.01"):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_planted_boilerplate_lines_are_told_from_the_prose_around(spark):
    docs, labels = _labelled(spark)
    field = quality.fit_line_field(docs, labels)
    marked = docs.join(labels, "doc_id")
    good = [r.text for r in marked.where("quality = 1").orderBy("doc_id").limit(60).collect() if r.text.count("\n") >= 4]
    bad = [r.text.split("\n") for r in marked.where("quality = 0").orderBy("doc_id").limit(30).collect()]
    junk = ["Home | About | Login | Help | Contact", "*** $$$ ### *** &&& %%% ***", "<div> | <a> | </a> | </div>", "BUY!!! NOW!!! $$$ 50% ***"]
    junk += [line for lines in bad for line in lines if sum(c in "#*$%&|<>" for c in line) >= 4][:20]
    right = total = mixed = 0
    for k, text in enumerate(good):
        lines = [x for x in text.split("\n") if x.strip()]
        head, foot = [junk[(k + j) % len(junk)] for j in range(3)], [junk[(2 * k + j) % len(junk)] for j in range(2)]
        whole = "\n".join([*head, *lines, *foot]).encode()
        m = quality.measure(np.frombuffer(whole, np.uint8), np.array([0, len(whole)]))
        found = field.decode(m["features"], m["line_row"])
        expected = np.array([False] * 3 + [True] * len(lines) + [False] * 2)
        right, total = right + int((found == expected).sum()), total + len(expected)
        share = quality.judge(pa.array([whole.decode()]), field)["content_share"][0]
        mixed += 0 < share < 1
    assert len(good) > 30 and right >= 0.95 * total and mixed >= 0.95 * len(good)


def test_stretches_lie_in_the_whole_text():
    assert quality.stretches(200, 1) == [(0, 200)]
    starts = {a for mark in range(300) for a, b in quality.stretches(10_000, mark) if b - a == quality.STRETCH_LINES and b <= 10_000}
    assert min(starts) < 500 and max(starts) > 9500 and len(starts) > 800


def test_pieces_of_a_language_lie_in_the_whole_text():
    text = np.frombuffer(("é" * 30_000).encode(), np.uint8)
    for mark in range(50):
        for piece in langid.training_pieces(text, mark):
            assert piece[0] & 0xC0 != 0x80
    ends = [langid.training_pieces(np.frombuffer(bytes([97 + k // 1000 for k in range(20_000)]), np.uint8), mark)[1][0] for mark in range(200)]
    assert min(ends) == 97 and max(ends) >= 97 + 18
    assert langid.training_pieces(np.frombuffer(b"abc", np.uint8), 1) == []


def test_language_scores_do_not_depend_on_slices(monkeypatch):
    rng = np.random.default_rng(3)
    model = langid.LanguageModel([f"l{k}" for k in range(37)], rng.normal(size=(1 << langid.BITS, 37)), rng.normal(size=37))
    texts = [b"", b"a", b"ab", "Straße über".encode(), b"words and more words " * 30, b"xyz"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])

    def alone(text):
        """One text: the mean of the rows of its n-grams."""
        low = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in text)
        rows = [int(langid._grams(np.frombuffer(low[k : k + n], np.uint8))[n][0]) for n in langid.ORDERS for k in range(len(low) - n + 1)]
        z = (np.mean([model.table[r] for r in rows], axis=0) if rows else 0) + model.bias
        p = np.exp(z - z.max())
        return int(p.argmax()), float((p / p.sum()).max())

    for grams, wide in ((1 << 17, 16), (7, 5), (64, 100)):
        monkeypatch.setattr(langid, "SLICE_GRAMS", grams)
        monkeypatch.setattr(langid, "SLICE_LANGUAGES", wide)
        which, score = model.predict(data, offsets)
        for k, text in enumerate(texts):
            assert (which[k], round(score[k], 5)) == (alone(text)[0], round(alone(text)[1], 5))


def test_sample_is_bounded_for_hot_classes_and_hot_ids(spark):
    ids = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "IF(id % 10 = 0, 'b', 'a') AS label")
    sample = sampling.labelled_sample(ids, "label", 1500)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts["a"] == counts["b"] == 1500
    texts = sampling.with_texts(spark.createDataFrame([(7, "a"), (8, "a")], "doc_id long, label string"),
                                spark.range(100_000).selectExpr("IF(id < 99999, 7, 8) AS doc_id", "concat('text ', id % 5000) AS text"))
    assert sorted(r.doc_id for r in texts.collect()) == [7, 8]


def test_matches_against_every_entry_at_every_word(spark):
    rng = random.Random(6)
    words = ["bad", "badly", "ban", "good", "not", "so", "b4d", "BAD", "very", "dab"]
    lexicon = toxicity.Lexicon({" bad": 2.0, " ban ": 1.5, " dab": 1.0}, {" not bad ", " bad good ", " so dab "}, (1.0, 0.5, -2.0))
    matcher = lexicon.matcher()
    for _ in range(400):
        line = toxicity._line(toxicity.folded_words(" ".join(rng.choices(words, k=rng.randrange(12)))))
        void = [(k, k + len(p)) for p in lexicon.exceptions for k in range(len(line)) if line.startswith(p, k)]
        expected = {}
        for k in range(len(line)):
            for entry, weight in lexicon.weights.items():
                if line.startswith(entry, k) and not any(a <= k and k + len(entry) <= b for a, b in void):
                    expected[k] = max(weight, expected.get(k, 0.0))
        assert toxicity.Lexicon.found(matcher, line) == expected, line

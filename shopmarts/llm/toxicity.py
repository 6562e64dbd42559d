"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

Folding lowers the text, turns letters that look alike (Cyrillic, Greek, full width) into Latin ones,
undoes digits and signs that stand for letters inside a word, and leaves words with single blanks.
Entries are whole words or beginnings of words, learned from labelled documents outside the test fold:
candidates are far more frequent in toxic texts than in others, and a greedy cover keeps those that
explain toxic documents not explained yet, which leaves out words that only come along with copies.
An exception phrase (an entry with the word before or after it) that occurs in clean texts only voids
the matches inside it. A logistic curve on the weight found and on the weight per word gives the score.

Parameter of the fit: ``TRAIN_DOCS`` documents per class, one text of each. Whole
texts are scored. Defined results: a null or empty text has no match and the score of such; without
labels of both classes every score is 0; repeated rows each give a row; a null id is held out.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.sampling import held_out, labelled_sample, with_texts
from shopmarts.llm.stored import bounded_batches

TRAIN_DOCS = 4000
SHORTEST, LONGEST = 4, 8
MIN_SUPPORT = 4
COVER_DEPTH = 3
MIN_LOG_ODDS = 2.5
FLUSH_UNITS = 200_000

# Letters of other scripts that look like a Latin one, in the order of their lower-case forms.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɡ": "g", "ⅼ": "l",
}
# Digits and signs that stand for a letter.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_LOOK = str.maketrans(LOOKALIKES) | {ord(c): None for c in "​‌‍⁠﻿­"}
_FOREIGN = re.compile("[­ıɐ-\U0010ffff]")
_SUBS = str.maketrans(SUBSTITUTES)
_DISGUISED = re.compile(r"[0134578@$!]{0,2}[^\W\d_]+(?:[0134578@$!]{1,3}[^\W\d_]+)+|(?<![0-9])[0134578@$!]{1,2}[^\W\d_]{2,}")
_DISGUISE = re.compile(r"[0134578@$!][^\W\d_]")
_WORDS = re.compile(r"[^\W\d_]+")


def folded_words(text: str | None) -> list[str]:
    t = (text or "").lower()
    if not t.isascii() and _FOREIGN.search(t):
        t = unicodedata.normalize("NFKC", t).lower().translate(_LOOK)
    if _DISGUISE.search(t):
        t = _DISGUISED.sub(lambda m: m.group().translate(_SUBS), t)
    return _WORDS.findall(t)


def _units(word: str):
    """Entries that would match a word: its beginnings, then itself."""
    for n in range(SHORTEST, min(LONGEST, len(word) - 1) + 1):
        yield " " + word[:n]
    if len(word) >= 3:
        yield f" {word} "


class Lexicon:
    """Entries with weights, exception phrases and the score's curve."""

    def __init__(self, weights: dict[str, float], exceptions: set[str] = frozenset(), curve=(0.0, 0.0, -30.0)):
        self.weights, self.exceptions, self.curve = weights, exceptions, curve

    def matcher(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            if phrase not in self.weights:
                found.add_word(phrase, (len(phrase), None))
        found.make_automaton()
        return found if len(found) else None

    @staticmethod
    def found(matcher, line: str) -> dict[int, float]:
        """Weight of the heaviest entry by the start of its word, without those inside an exception."""
        best: dict[int, float] = {}
        void = []
        if matcher is None:
            return best
        for last, (length, weight) in matcher.iter(line):
            at = last - length + 1
            if weight is None:
                void.append((at, last))
            elif weight > best.get(at, 0.0):
                best[at] = weight
        if not void:
            return best
        void.sort()
        starts = [s for s, _ in void]
        reach = list(accumulate((e for _, e in void), max))  # how far the phrases that begin up to here go
        return {a: w for a, w in best.items() if not (k := bisect_right(starts, a)) or a >= reach[k - 1]}

    def score(self, weight: float, n_words: int) -> float:
        a, b, c = self.curve
        z = a * math.log1p(weight) + b * math.log1p(100 * weight / max(n_words, 1)) + c
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _line(words: list[str]) -> str:
    return f" {' '.join(words)} "


def _texts(batch) -> list:
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def _unit_counts(batches):
    """Documents by unit and class, summed per task as far as memory allows."""
    counts: Counter = Counter()

    def flush():
        rows = [(u, y, n) for (u, y), n in counts.items()]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int64()))], names=["unit", "label", "n"])

    for batch in batches:
        for y, text in zip(batch.column(1).to_pylist(), _texts(batch)):
            units = set()
            for word in set(folded_words(text)):
                units.update(_units(word))
            counts.update((u, y) for u in units)
            if len(counts) > FLUSH_UNITS:
                yield flush()
    yield flush()


def _cover(held: list[list[str]], weights: dict[str, float], clean: dict[str, int]) -> set[str]:
    """Entries, best first, that each explain enough documents seen less than COVER_DEPTH times so far."""
    where = defaultdict(list)
    for i, units in enumerate(held):
        for u in units:
            where[u].append(i)
    depth = np.zeros(len(held), int)
    chosen: set[str] = set()
    gains = {u: len(d) for u, d in where.items()}
    while gains:
        unit = max(gains, key=lambda u: (gains[u] - 5 * clean.get(u, 0), weights[u], len(u), u))
        real = int((depth[where[unit]] < COVER_DEPTH).sum())
        if real < gains[unit]:  # others have been chosen since it was last looked at
            gains[unit] = real
            if real < MIN_SUPPORT:
                del gains[unit]
            continue
        if gains.pop(unit) - 5 * clean.get(unit, 0) < MIN_SUPPORT:
            break
        if any(unit.startswith(c) for c in chosen if not c.endswith(" ")):
            continue  # a shorter beginning matches the same words
        chosen.add(unit)
        depth[where[unit]] += 1
    return chosen


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by damped Newton steps, both classes weighing the same."""
    a = np.column_stack([x, np.ones(len(x))])
    side = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    theta = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -60, 60)))
        slope = a.T @ (side * (y - p)) - 1e-3 * theta
        bend = (a * (side * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(3)
        theta = theta + np.linalg.solve(bend, slope)
    return tuple(float(t) for t in theta)


def fit_lexicon(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> Lexicon:
    """Lexicon and curve from labelled documents outside the test fold."""
    sample = with_texts(labelled_sample(labels.where(~held_out(F.col("doc_id"))), "toxic", train_docs), docs)
    sample = sample.select("doc_id", F.col("label").cast("int").alias("label"), "text")
    classes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.countDistinct("text").alias("n")).collect()}
    if set(classes) != {0, 1}:
        return Lexicon({})
    distinct = sample.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label")).select("doc_id", "label", "text")
    odds = F.log((F.col("toxic") + 0.5) / (classes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (classes[0] + 1.0))
    candidates = (
        distinct.mapInArrow(_unit_counts, "unit string, label int, n long").groupBy("unit")
        .agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"))
        .where(F.col("toxic") >= MIN_SUPPORT).withColumn("weight", odds).where(F.col("weight") >= MIN_LOG_ODDS)
        .collect()  # all entries of the bounded sample that reach the bounds
    )
    weights = {r["unit"]: r["weight"] for r in candidates}
    clean = {r["unit"]: r["clean"] for r in candidates}

    def held_units(batches):
        for batch in batches:
            out = [[u for u in {u for w in set(folded_words(t)) for u in _units(w)} if u in weights] for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["units"])

    held = distinct.where("label = 1").mapInArrow(held_units, "units array<string>").collect()
    chosen = _cover(sorted(sorted(r["units"]) for r in held), weights, clean)
    lexicon = Lexicon({u: weights[u] for u in sorted(chosen)})

    def contexts(batches):
        """Weight and length of each text, and the phrases around its matches."""
        matcher = lexicon.matcher()
        for batch in batches:
            out = []
            for y, text in zip(batch.column(1).to_pylist(), _texts(batch)):
                words = folded_words(text)
                line = _line(words)
                found = Lexicon.found(matcher, line)
                phrases = set()
                for at in found:
                    end = line.index(" ", at + 1)
                    after, before = line.find(" ", end + 1), line.rfind(" ", 0, at)
                    if after > 0:
                        phrases.add(line[at : after + 1])
                    if before >= 0:
                        phrases.add(line[before : end + 1])
                out.append((y, sum(found.values()), len(words), sorted(phrases)))
            types = (pa.int32(), pa.float64(), pa.int64(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=["label", "weight", "n_words", "phrases"])

    rows = distinct.mapInArrow(contexts, "label int, weight double, n_words long, phrases array<string>").collect()
    seen = {y: Counter(p for r in rows if r["label"] == y for p in r["phrases"]) for y in (0, 1)}
    exceptions = {p for p, n in seen[0].items() if n >= 3 and seen[1][p] == 0}
    x = np.array([[math.log1p(r["weight"]), math.log1p(100 * r["weight"] / max(r["n_words"], 1))] for r in rows])
    y = np.array([r["label"] for r in rows])
    order = np.lexsort((y, x[:, 1], x[:, 0]))
    return Lexicon(lexicon.weights, exceptions, _fit_curve(x[order], y[order]))


def toxicity(docs: DataFrame, labels: DataFrame, lexicon: Lexicon | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted and n_matches for every row."""
    bounded_batches(docs.sparkSession)
    lexicon = lexicon or fit_lexicon(docs, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_matches", pa.int64())])

    def run(batches):
        matcher = lexicon.matcher()
        for batch in batches:
            scores, matches = [], []
            for text in batch.column(2):
                words = folded_words(text.as_py())
                found = Lexicon.found(matcher, _line(words))
                scores.append(lexicon.score(sum(found.values()), len(words)) if matcher else 0.0)
                matches.append(len(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()),
                                              pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(matches, pa.int64())], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int, n_matches long")

"""Language identification: averaged hashed subword embeddings and a linear softmax.

Byte 2-, 3- and 4-grams of the lower-cased text, with everything but letters as one blank, are hashed
into ``2 ** BITS`` rows of an embedding; a text is the mean of its rows, and a linear softmax on top
gives the language. Both layers are trained together by stochastic gradient descent in numpy, on a
bounded sample: at most ``TRAIN_DOCS`` documents per language, of each a stretch of ``TRAIN_BYTES`` and two
short ones, from hashed places of the whole text. A fifth of the documents are not trained on; they set
the temperature of the scores and the score below which a prediction is marked ``rejected``. Whole texts
are classified.

Defined results: ``und`` with score 0 where a text is null or has no letter, and where no language was
learned; repeated rows each give a row; a null id is held out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.sampling import held_out, labelled_sample, with_texts
from shopmarts.llm.stored import bounded_batches
from shopmarts.llm.textblocks import blocks

BITS = 15
DIMENSIONS = 16
ORDERS = (2, 3, 4)
TRAIN_DOCS = 500
TRAIN_BYTES = 6000
SHORT_BYTES = (40, 200)
EPOCHS = 6
LEARNING_RATE = 0.6
PRECISION = 0.99
SLICE_GRAMS = 1 << 17
SLICE_LANGUAGES = 16

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def _grams(data: np.ndarray) -> dict[int, np.ndarray]:
    """Row of the embedding for the n-gram that starts at each byte, by n."""
    letters = _FOLD[data].astype(np.uint32)
    code, out = letters, {}
    for n in range(2, max(ORDERS) + 1):
        code = code[:-1] + (letters[n - 1 :] << np.uint32(8 * (n - 1)))
        if n in ORDERS:
            h = code * np.uint32(2654435761) + np.uint32(n * 97)
            h ^= h >> np.uint32(15)
            h *= np.uint32(2246822519)
            out[n] = h >> np.uint32(32 - BITS)
    return out


def _counts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, n = np.unique(np.concatenate(list(_grams(data).values())), return_counts=True)
    return rows.astype("<u2"), (n / max(1, n.sum())).astype("<f4")


class LanguageModel:
    """Scores per embedding row (the two layers multiplied out), temperature and rejection bound."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray):
        self.languages, self.table, self.bias = languages, table.astype(np.float32), bias
        self.temperature, self.reject_below = 1.0, 0.0

    @classmethod
    def fit(cls, examples: list[tuple[str, np.ndarray, np.ndarray]], checked: list[bool] | None = None) -> LanguageModel:
        """``checked`` marks examples that only calibrate; all pieces of a document go together."""
        languages = sorted({e[0] for e in examples})
        place = {name: i for i, name in enumerate(languages)}
        rng = np.random.default_rng(7)
        embedding = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)) / DIMENSIONS
        out, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
        checked = checked or [False] * len(examples)
        train = [e for e, c in zip(examples, checked) if not c] or examples
        check = [e for e, c in zip(examples, checked) if c] or train
        steps, done = EPOCHS * len(train), 0
        for _ in range(EPOCHS):
            for i in rng.permutation(len(train)):
                name, rows, share = train[i]
                rate = LEARNING_RATE * (1 - done / steps)
                done += 1
                hidden = share @ embedding[rows]
                logits = hidden @ out + bias
                error = np.exp(logits - logits.max())
                error /= error.sum()
                error[place[name]] -= 1
                back = out @ error
                out -= rate * np.outer(hidden, error)
                bias -= 0.1 * rate * error
                embedding[rows] -= rate * DIMENSIONS * np.outer(share, back)
        model = cls(languages, embedding @ out, bias)
        model._calibrate([(place[n], share @ model.table[rows] + bias) for n, rows, share in check])
        return model

    def _calibrate(self, checked: list[tuple[int, np.ndarray]]) -> None:
        truth = np.array([t for t, _ in checked])
        logits = np.array([x for _, x in checked])

        def scores(temperature):
            z = logits / temperature
            z = np.exp(z - z.max(axis=1, keepdims=True))
            return z / z.sum(axis=1, keepdims=True)

        rows = np.arange(len(truth))
        loss = lambda t: -np.log(np.maximum(scores(t)[rows, truth], 1e-12)).mean()
        self.temperature = float(min(np.geomspace(0.2, 5, 40), key=loss))
        s = scores(self.temperature)
        best, right = s.max(axis=1), s.argmax(axis=1) == truth
        order = np.argsort(-best, kind="stable")
        precise = np.flatnonzero(np.cumsum(right[order]) >= PRECISION * (rows + 1))
        self.reject_below = float(best[order[precise[-1]]]) if len(precise) else 1.0

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the language, score) of every row of a block; scores are gathered for some languages and
        some grams at a time, so memory is that of a slice, whatever the number of languages or the text's length."""
        n, wide = len(offsets) - 1, len(self.languages)
        total, count = np.zeros((n, wide)), np.zeros(n)
        for order, rows in _grams(data).items():
            # grams that start in a row and end in it
            start, end = offsets[:-1], np.maximum(offsets[1:] - order + 1, offsets[:-1])
            count += end - start
            for a in range(0, len(rows), SLICE_GRAMS):
                b = min(a + SLICE_GRAMS, len(rows))
                low, high = np.clip(start, a, b) - a, np.clip(end, a, b) - a
                some = np.flatnonzero(high > low)
                cuts = np.stack([low[some], high[some]], axis=1).ravel()
                for k in range(0, wide if len(some) else 0, SLICE_LANGUAGES):
                    values = np.append(self.table[rows[a:b], k : k + SLICE_LANGUAGES], np.zeros((1, min(SLICE_LANGUAGES, wide - k)), np.float32), axis=0)
                    total[some, k : k + SLICE_LANGUAGES] += np.add.reduceat(values, cuts, axis=0)[::2]
        z = (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        return z.argmax(axis=1), z.max(axis=1)


def _lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a letter; only rows without an ASCII letter are decoded."""
    ascii_letter = np.zeros(256, np.int64)
    ascii_letter[65:91] = ascii_letter[97:123] = 1
    total = np.concatenate([[0], np.cumsum(ascii_letter[data])])
    out = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~out):
        part = data[offsets[i] : offsets[i + 1]]
        out[i] = bool((part > 127).any()) and any(c.isalpha() for c in part.tobytes().decode())
    return out


def fit_language_model(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> LanguageModel | None:
    """The model from documents outside the test fold, or None if none has a language."""
    sample = with_texts(labelled_sample(docs.where(~held_out(F.col("doc_id"))), "lang", train_docs), docs)

    def examples(batches):
        for batch in batches:
            out = []
            for row, end, data, offsets in blocks(batch.column(2)):
                for k in range(row, end):
                    text = data[offsets[k - row] : offsets[k - row + 1]]
                    name, mark = batch.column(1)[k].as_py(), zlib.crc32(text)
                    for piece in training_pieces(text, mark):
                        rows, share = _counts(piece)
                        out.append((name, mark % 5 == 0, rows.tobytes(), share.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.bool_(), pa.binary(), pa.binary()))],
                                             names=["lang", "checked", "rows", "share"])

    rows = sample.select("doc_id", F.col("label").cast("string"), "text").mapInArrow(examples, "lang string, checked boolean, rows binary, share binary").collect()
    rows = sorted({(r["lang"], r["checked"], bytes(r["rows"]), bytes(r["share"])) for r in rows}, key=lambda r: (r[2], r[0], r[3], r[1]))
    if not rows:
        return None
    return LanguageModel.fit([(name, np.frombuffer(a, "<u2").astype(np.int64), np.frombuffer(b, "<f4").astype(float)) for name, _, a, b in rows], [c for _, c, _, _ in rows])


def training_pieces(text: np.ndarray, mark: int) -> list[np.ndarray]:
    """A long stretch of the text and short ones, from places that its hash picks; stretches begin at a character."""
    out = []
    for turn, size in enumerate((TRAIN_BYTES, *SHORT_BYTES)):
        at = zlib.crc32(b"%d" % turn, mark) % max(1, len(text) - size + 1)
        while at and text[at] & 0xC0 == 0x80:
            at -= 1
        out.append(text[at : at + size])
    return [piece for piece in out if len(piece) >= 4]


def languages(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected for every row."""
    bounded_batches(docs.sparkSession)
    model = model or fit_language_model(docs)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        for batch in batches:
            names, scores = [], []
            for row, end, data, offsets in blocks(batch.column(2)):
                if model is None:
                    known, which, score = np.zeros(end - row, bool), np.zeros(end - row, int), np.zeros(end - row)
                else:
                    known, (which, score) = _lettered(data, offsets), model.predict(data, offsets)
                names += [model.languages[w] if k else "und" for k, w in zip(known, which)]
                scores.append(np.where(known, score, 0.0))
            scores = np.concatenate(scores) if scores else np.zeros(0)
            bound = model.reject_below if model else 1.0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores), pa.array(scores < bound)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")

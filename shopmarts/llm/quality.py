"""Quality rules: a linear-chain conditional random field labels every line content or boilerplate.

Base counts come first and reject a text with few words or much repetition. For the others, Viterbi
decoding finds the best label sequence of all lines, and the share of word characters in content lines
decides.

The field is fitted on chains that hold both labels, from a bounded sample of documents with a quality
label. Boilerplate are all lines of documents of quality 0 and, in documents of quality 1, lines of symbols
and lines that documents of quality 0 have too; content are the other lines of documents of quality 1. As
a labelled document is good or bad as a whole, lines of a bad one are set before and behind each good
stretch, the way navigation and footers stand around an article.

Parameters of the fit: ``TRAIN_DOCS`` documents per class, one text of each, and of each text at most
``STRETCHES`` stretches of ``STRETCH_LINES`` lines, from hashed places of the whole text. All of every text
is labelled.

Defined results: a null or empty text has no words and fails the base; without labels of both classes the
base alone decides; repeated rows each give a row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmarts.llm.sampling import labelled_sample, with_texts
from shopmarts.llm.stored import bounded_batches
from shopmarts.llm.textblocks import U64, SpanHasher, blocks, gram_hashes, mix64, word_bounds

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
TRAIN_DOCS = 1500
STRETCHES, STRETCH_LINES = 4, 50
FRAME_LINES = 6  # lines of a bad document on either side of a good stretch, fewer than this
SYMBOL_SHARE = 0.1
TRAIN_STEPS = 200
BLOCK = 1 << 18  # bytes of text judged together

SYMBOLS = b"#*$%&|<>"
_SYMBOL, _UPPER, _DIGIT, _STOP, _BANG, _LETTER = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[list(SYMBOLS)] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_STOP[list(b".,;:?")] = True
_BANG[list(b"!")] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
FEATURES = ("one", "symbols", "upper", "bangs", "digits", "stops", "letters", "repeats", "short", "long_words", "ends", "seen")


def _sums(flags: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[end] - total[start]


def _per_row(row: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(row, weights, n).astype(np.int64)


def _repeats(keys: np.ndarray) -> np.ndarray:
    """Marks every key but one of each value."""
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(keys), bool)
    if len(keys):
        again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return again


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Base counts per row, and features, row and word characters per line."""
    n = len(offsets) - 1
    start, end, row = word_bounds(data, offsets)
    hasher = SpanHasher(data)
    words = hasher(start, end)
    points = (data & 0xC0) != 0x80
    chars = _sums(points, start, end)

    rowed = mix64(row.astype(np.uint64) + U64(1))
    grams, first = gram_hashes(words, row, 3)
    keys = grams ^ rowed[first]
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    marked = np.zeros(len(words), bool)
    for k in range(3):
        marked[first[twice] + k] = True

    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    line_end = np.sort(np.concatenate([offsets[1:], breaks]), kind="stable")
    break_row = np.searchsorted(offsets, breaks, side="right") - 1
    line_row = np.sort(np.concatenate([np.arange(n), break_row]), kind="stable")
    word_line = np.searchsorted(line_start, start, side="right") - 1
    n_lines = len(line_start)
    line_words = _per_row(word_line, n_lines)
    filled = line_words > 0
    line_hash = hasher(line_start, line_end) ^ mix64(line_row.astype(np.uint64) + U64(1))
    seen = np.zeros(n_lines, bool)
    seen[np.flatnonzero(filled)] = _repeats(line_hash[filled])

    size = np.maximum(line_end - line_start, 1).astype(float)
    line_chars = _per_row(word_line, n_lines, chars)
    word_again = _repeats(words ^ mix64(word_line.astype(np.uint64) + U64(7)))
    share = lambda table: _sums(table[data], line_start, line_end) / size
    last = data[np.maximum(line_end - 1, 0)] if len(data) else np.zeros(n_lines, np.uint8)
    features = np.stack([
        np.ones(n_lines), np.minimum(share(_SYMBOL) * 5, 1), share(_UPPER), np.minimum(share(_BANG) * 5, 1), share(_DIGIT),
        np.minimum(share(_STOP) * 10, 1), share(_LETTER), _per_row(word_line, n_lines, word_again) / np.maximum(line_words, 1),
        1 / (1 + line_words), np.minimum(line_chars / np.maximum(line_words, 1) / 12, 1), _STOP[last] & filled, seen,
    ], axis=1)
    return {
        "n_words": _per_row(row, n), "word_chars": _per_row(row, n, chars),
        "n_symbols": _sums(_SYMBOL[data], offsets[:-1], offsets[1:]),
        "n_dup_lines": _per_row(line_row, n, seen), "n_repeat_words": _per_row(row, n, marked),
        "features": features[filled], "line_row": line_row[filled], "line_chars": line_chars[filled], "line_hash": hasher(line_start, line_end)[filled],
    }


class LineField:
    """A chain of two labels, 1 for content: weights for what a line shows, and one for a label that goes on.

    Both labels go on with the same weight; which is the more frequent is the constant feature's to say, so a
    text of one line is judged like any other.
    """

    def __init__(self, weights=None, moves=None):
        self.weights = np.zeros(len(FEATURES)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def fit(self, sequences: list[np.ndarray], labels: list[np.ndarray], steps: int = TRAIN_STEPS, penalty: float = 1e-3) -> LineField:
        """Maximise the likelihood of the labels of the sequences' lines."""
        longest = max(map(len, sequences))
        x = np.zeros((longest, len(sequences), len(FEATURES)))
        there = np.zeros((longest, len(sequences)), bool)
        y = np.zeros((longest, len(sequences)))
        for i, (s, label) in enumerate(zip(sequences, labels)):
            x[: len(s), i], there[: len(s), i], y[: len(s), i] = s, True, label
        # both labels weigh the same; of one label, lines do
        balance = np.where(y == 1, 0.5 / max(1, (there & (y == 1)).sum()), 0.5 / max(1, (there & (y == 0)).sum()))
        step_first = np.zeros(len(FEATURES) + 1)
        step_second = step_first.copy()
        theta = np.append(self.weights, self.moves[0, 0])
        links = there[1:]
        for t in range(1, steps + 1):
            w, moves = theta[:-1], theta[-1] * np.eye(2)
            score = x @ w / 2
            emit = np.stack([-score, score], axis=2)
            ahead = np.zeros_like(emit)
            ahead[0] = emit[0]
            for k in range(1, longest):
                into = np.logaddexp(ahead[k - 1, :, 0, None] + moves[0], ahead[k - 1, :, 1, None] + moves[1])
                ahead[k] = np.where(there[k, :, None], into + emit[k], ahead[k - 1])
            back = np.zeros_like(emit)
            for k in range(longest - 2, -1, -1):
                out = np.logaddexp(moves[:, 0] + (emit[k + 1, :, 0] + back[k + 1, :, 0])[:, None],
                                   moves[:, 1] + (emit[k + 1, :, 1] + back[k + 1, :, 1])[:, None])
                back[k] = np.where(there[k + 1, :, None], out, 0.0)
            total = np.logaddexp(ahead[-1, :, 0], ahead[-1, :, 1])
            p1 = np.exp(ahead[..., 1] + back[..., 1] - total)
            gradient = np.zeros_like(theta)
            gradient[:-1] = np.einsum("kif,ki->f", x, (y - p1) * there * balance)
            for a in range(2):
                pair = np.exp(ahead[:-1, :, a] + moves[a, a] + emit[1:, :, a] + back[1:, :, a] - total)
                truth = (y[:-1] == a) & (y[1:] == a)
                gradient[-1] += ((truth - pair) * links * balance[1:]).sum()
            gradient -= penalty * theta
            step_first = 0.9 * step_first + 0.1 * gradient
            step_second = 0.99 * step_second + 0.01 * gradient**2
            theta = theta + 0.1 * (step_first / (1 - 0.9**t)) / (np.sqrt(step_second / (1 - 0.99**t)) + 1e-9)
        return LineField(theta[:-1], theta[-1] * np.eye(2))

    def decode(self, features: np.ndarray, line_row: np.ndarray) -> np.ndarray:
        """Viterbi labels of consecutive lines; a new row starts a new chain."""
        n = len(features)
        scores = (features @ self.weights).tolist()
        starts = np.ones(n, bool)
        starts[1:] = line_row[1:] != line_row[:-1]
        starts = starts.tolist()
        (t00, t01), (t10, t11) = self.moves.tolist()
        from0, from1 = [0] * n, [0] * n  # best label before, if this line has label 0 or 1
        ends = [0] * n
        lead = 0.0  # how far label 1 is ahead of label 0
        for i in range(n):
            if starts[i]:
                lead = scores[i]
            else:
                into1, into0 = lead + t11, lead + t10
                from1[i], from0[i] = into1 >= t01, into0 >= t00
                lead = scores[i] + (into1 if into1 >= t01 else t01) - (into0 if into0 >= t00 else t00)
            ends[i] = lead >= 0
        out = np.zeros(n, bool)
        label = 0
        for i in range(n - 1, -1, -1):
            if i == n - 1 or starts[i + 1]:
                label = ends[i]
            out[i] = label
            label = from1[i] if label else from0[i]
        return out


def stretches(n_lines: int, mark: int) -> list[tuple[int, int]]:
    """Where the stretches of a text lie: all of a short text, else one hashed place in each equal part."""
    if n_lines <= STRETCHES * STRETCH_LINES:
        return [(0, n_lines)]
    cuts = np.linspace(0, n_lines, STRETCHES + 1).astype(int).tolist()
    starts = [a + zlib.crc32(b"%d" % k, mark) % (b - a - STRETCH_LINES + 1) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return [(a, a + STRETCH_LINES) for a in starts]


def training_chains(bad: list[np.ndarray], good: list[np.ndarray], good_lines: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(features, labels) of chains: bad stretches as they are, good ones framed by lines of bad ones.

    ``good_lines`` marks the lines of each good stretch that are content.
    """
    chains, labels = list(bad), [np.zeros(len(x)) for x in bad]
    for k, (x, content) in enumerate(zip(good, good_lines)):
        parts, marks = [x], [content.astype(float)]
        if bad:
            mark = zlib.crc32(x.tobytes())
            before, after = (bad[(mark >> shift) % len(bad)][: (mark >> shift + 8) % FRAME_LINES] for shift in (0, 12))
            parts, marks = [before, x, after], [np.zeros(len(before)), marks[0], np.zeros(len(after))]
        chains.append(np.concatenate(parts))
        labels.append(np.concatenate(marks))
    return chains, labels


def fit_line_field(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> LineField | None:
    """The field, or None without lines of both labels."""
    sample = with_texts(labelled_sample(labels, "quality", train_docs), docs)

    def lines(batches):
        for batch in batches:
            ids, marks = batch.column(0), batch.column(1)
            for row, end, data, offsets in blocks(batch.column(2)):
                m = measure(data, offsets)
                out = []
                for k in range(end - row):
                    mine = slice(np.searchsorted(m["line_row"], k), np.searchsorted(m["line_row"], k, side="right"))
                    features, hashes = m["features"][mine].astype("<f4"), m["line_hash"][mine]
                    if len(features):
                        mark = zlib.crc32(data[offsets[k] : offsets[k + 1]])
                        out += [(ids[row + k].as_py(), a, int(marks[row + k].as_py()), features[a:b].tobytes(), hashes[a:b].tobytes()) for a, b in stretches(len(features), mark)]
                types = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=["doc_id", "start", "label", "lines", "hashes"])

    rows = sample.select("doc_id", F.col("label").cast("int"), "text").mapInArrow(lines, "doc_id long, start long, label int, lines binary, hashes binary").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["start"]))
    hashes = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
    x = [np.frombuffer(r["lines"], "<f4").reshape(-1, len(FEATURES)).astype(float) for r in rows]
    is_bad = [r["label"] != 1 for r in rows]
    bad_lines = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for h, b in zip(hashes, is_bad) if b)]))
    content = [(f[:, FEATURES.index("symbols")] < 5 * SYMBOL_SHARE) & ~np.isin(h, bad_lines) for f, h in zip(x, hashes)]
    good = [k for k, b in enumerate(is_bad) if not b]
    chains, marks = training_chains([f for f, b in zip(x, is_bad) if b], [x[k] for k in good], [content[k] for k in good])
    if len(set(np.concatenate([np.zeros(0), *marks]).tolist())) < 2:
        return None
    return LineField().fit(chains, marks)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(column: pa.Array, field: LineField | None) -> dict[str, np.ndarray]:
    """Counts, content share and verdict of every text of an Arrow column."""
    parts: dict[str, list] = {k: [] for k in (*_COUNTS, "base_failed", "kept", "content_share")}
    for _, _, data, offsets in blocks(column, BLOCK):
        m = measure(data, offsets)
        failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
        content = field.decode(m["features"], m["line_row"]) if field else np.ones(len(m["line_row"]), bool)
        share = _per_row(m["line_row"], len(failed), m["line_chars"] * content) / np.maximum(m["word_chars"], 1)
        for k in _COUNTS:
            parts[k].append(m[k])
        parts["base_failed"].append(failed)
        parts["content_share"].append(share)
        parts["kept"].append(~failed & (share >= CONTENT_SHARE))
    return {k: np.concatenate(v) if v else np.zeros(0) for k, v in parts.items()}


def quality(docs: DataFrame, labels: DataFrame, field: LineField | None = None) -> DataFrame:
    """doc_id, base counts, base_failed, kept and content_share for every row."""
    bounded_batches(docs.sparkSession)
    field = field or fit_line_field(docs, labels)

    def run(batches):
        for batch in batches:
            m = judge(batch.column(1), field)
            names = (*_COUNTS, "base_failed", "kept", "content_share")
            types = (*[pa.int64()] * 5, pa.bool_(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(m[k], t) for k, t in zip(names, types))], names=["doc_id", *names])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
             " base_failed boolean, kept boolean, content_share double")


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are kept, unchanged."""
    bounded_batches(docs.sparkSession)
    field = fit_line_field(docs, labels)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column(at), field)["kept"], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

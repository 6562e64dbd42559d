"""Plain restatements of the contracts, one text at a time, and small awkward tables."""
from __future__ import annotations

import hashlib
import re
from collections import Counter

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

AWKWARD = [
    (0, None), (1, ""), (2, "   \n\t "), (3, "one"), (4, "one"), (4, "one"), (5, "a b c d e " * 40), (6, "é" * 70000),
    (7, "x" * 200 + "\n\n" + "Ünï çödé " * 30), (None, "no id at all, but some words"), (8, "1" * 5000 + " " + "@" * 50),
    (9, "# $ % <b> | & *\n" * 20), (10, "word " * 30000),
]


def awkward(spark):
    """Nulls, empty, blank and very long texts, repeated rows, and columns named like the helpers' own."""
    rows = [(i, t, "en" if k % 2 else None, f"src{k % 3}" if k % 4 else None, len(t or "")) for k, (i, t) in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ["size", "h", "row", "block", "label", "id", "hash", "target", "bucket", "component_id", "kept", "score", "data"]
    return df.select("*", *[F.lit(7).alias(c) for c in extra])


def empty(spark):
    return awkward(spark).where("false")


def quality_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    marked = {k + d for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for d in range(3)}
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked), failed)


def base_spans(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))]
        return sum(doubled) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m.group())]


def spans_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()

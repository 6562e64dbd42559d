"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Four kinds are the base and are decided by pattern and check alone: email, ip (parts up to 255), card
(16 to 19 digits, Luhn) and phone (8 to 15 digits after a plus sign). Further kinds need a score of
``KEEP_SCORE``: IBAN (mod-97 confirms it), cards of 13 to 15 digits (Luhn), social security numbers and
telephone numbers without a plus sign (both only next to a word that names them). They never overlap a
base span or one another.

Defined results: a null or empty text has no spans; every row gives one row, repeated ids included;
positions are code points. Patterns run in time linear in the text, also on very long runs of digits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KEEP_SCORE = 0.6
CONTEXT_CHARS = 40

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match never starts inside a run of digits: one from the run's first digit would have matched too
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")

# Words beside a number that speak for a kind (lower case).
CONTEXT_WORDS = {
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank", "bic"),
    "card": ("card", "credit", "visa", "mastercard", "amex", "karte", "carte", "tarjeta"),
    "ssn": ("ssn", "social security", "sozialversicherung", "securite sociale", "seguro social"),
    "phone": ("phone", "call", "tel", "mobile", "cell", "fax", "telefon", "telephone", "telefono", "contact"),
}
# Number of characters of an IBAN by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26,
    "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The ISO 7064 check of an IBAN without spaces."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: a local part never holds one."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
            at = text.find("@", free)
        else:
            free = max(free, at + 1)
            at = text.find("@", at + 1)


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four base kinds, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or "0") <= 255 for part in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _near(text: str, start: int, end: int, kind: str) -> bool:
    around = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS]}".lower()
    return any(re.search(rf"\b{w}\b", around) for w in CONTEXT_WORDS[kind])


def _iban_end(m: re.Match) -> int | None:
    """The end of the IBAN that starts here, if its country's length fits and mod-97 holds."""
    want = IBAN_LENGTH.get(m.group()[:2])
    got, end = 0, m.start()
    code = []
    for c in m.group():
        end += 1
        if c != " ":
            code.append(c)
            got += 1
            if got == want:
                break
    follows = m.string[end : end + 1]
    return end if got == want and not (follows.isascii() and follows.isalnum()) and mod97("".join(code)) else None


def more_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of further spans that reach ``KEEP_SCORE``."""
    proposed = []
    for m in _IBAN.finditer(text):
        if end := _iban_end(m):
            proposed.append(("iban", m.start(), end, 0.8))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 19 and 13 <= len(d := _digits(m.group())) <= 15 and luhn(d):
            proposed.append(("card", m.start(), m.end(), 0.4))  # one number in ten passes Luhn
    for m in _SSN.finditer(text):
        proposed.append(("ssn", m.start(), m.end(), 0.4))
    for m in _LOCAL_PHONE.finditer(text):
        proposed.append(("phone", m.start(), m.end(), 0.3))
    kept: list[tuple[str, int, int, float]] = []
    taken = [(a, b) for _, a, b in base]
    for kind, start, end, score in proposed:
        if _near(text, start, end, kind):
            score = min(1.0, score + 0.3)
        if score >= KEEP_SCORE and all(end <= a or b <= start for a, b in taken):
            kept.append((kind, start, end, score))
            taken.append((start, end))
    return kept


_ORDER = {k: i for i, k in enumerate((*BASE_KINDS, "iban", "ssn"))}


def find(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed, then start."""
    text = text or ""
    base = base_spans(text)
    more = [s[:3] for s in more_spans(text, base)]
    return base, sorted(base + more, key=lambda s: (_ORDER[s[0]], s[1]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in angle brackets."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end in sorted(find(text)[1], key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
            at = end
        else:
            at = max(at, end)  # kinds may overlap one another: the later one is gone with the first
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans, for every row of (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in BASE_KINDS),
                        ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                base, every = find(text.as_py())
                kinds = [k for k, _, _ in base]
                rows.append((doc_id, *(kinds.count(k) for k in BASE_KINDS),
                             hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 7, schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted_documents(docs: DataFrame) -> DataFrame:
    """The same rows with their personal data replaced in ``text``; ``n_chars``, if there, follows."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            clean = pa.array([redact(t.as_py()) for t in batch.column(at)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), clean)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out

"""Column expressions shared by the cleaning steps and the marts.

Everything here is a native Spark expression (whole-stage codegen, no Python per row).

Rounding contract (MySQL parity): an average or a quotient keeps ``input scale + 4`` digits,
rounded half up, and only then is rounded to the published digits. Spark's decimal ``avg`` already
has exactly that result type, so averages cast their input to a decimal of the right scale first.
Published ratios are cast to double at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace removed by Python's str.strip() (pandas .str.strip()): the Unicode White_Space set
# and the four ASCII separators.
STRIPPED = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))

# Text that pandas.read_csv turns into a missing value by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

DEFAULT_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------- text
def strip_ws(c) -> Column:
    """Python ``str.strip()``: leading/trailing Unicode whitespace; NULL stays NULL."""
    return F.trim(col_(c).cast("string"), F.lit(STRIPPED))


def clean_text(c) -> Column:
    """To string, strip, lower."""
    return F.lower(strip_ws(c))


def clean_code(c) -> Column:
    """Strip, then upper (state codes)."""
    return F.upper(strip_ws(c))


# The token list as one SQL literal list (no token contains a quote): one JVM call per column
# instead of one per token, which matters when a contract has dozens of columns.
_NA_SQL = ", ".join(f"'{t}'" for t in NA_TOKENS)


def na_to_null(c) -> Column:
    """Pandas default NA tokens become NULL (Spark's CSV reader only maps the empty string)."""
    if isinstance(c, str):
        q = f"`{c}`"
        return F.expr(f"CASE WHEN {q} IN ({_NA_SQL}) THEN NULL ELSE {q} END")
    return F.when(F.array_contains(F.expr(f"array({_NA_SQL})"), c), F.lit(None).cast("string")).otherwise(c)


_TS_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def to_datetime(c, fmt: str | None = DEFAULT_TS_FORMAT) -> Column:
    """Text to ``timestamp_ntz``; unparsable text becomes NULL instead of failing the job.

    The default format is parsed without any time zone (shape check, then a cast, then
    ``try_make_timestamp_ntz`` for what the cast does not take, which is second 60 and impossible dates;
    those are NULL), so the session zone and its daylight-saving gaps cannot move a wall-clock value.
    The parts are only taken where the cast fails: cutting them out costs twice the cast. Other formats go through
    ``try_to_timestamp`` in the session zone; ``fmt=None`` is the lenient variant (date-only too).
    """
    if fmt == DEFAULT_TS_FORMAT and isinstance(c, str):  # same expression, built in one JVM call
        s = f"CAST(`{c}` AS STRING)"
        parts = ", ".join(f"try_cast(substring({s}, {pos}, {n}) AS INT)"
                          for pos, n in ((1, 4), (6, 2), (9, 2), (12, 2), (15, 2), (18, 2)))
        return F.expr(f"CASE WHEN {s} RLIKE '{_TS_SHAPE}' THEN coalesce(try_cast(substring({s}, 1, 19) AS TIMESTAMP_NTZ),"
                      f" try_make_timestamp_ntz({parts})) END")
    s = col_(c).cast("string")
    if fmt == DEFAULT_TS_FORMAT:
        part = lambda pos, n: F.substring(s, pos, n).try_cast("int")
        made = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2), part(18, 2))
        return F.when(s.rlike(_TS_SHAPE), F.coalesce(F.substring(s, 1, 19).try_cast("timestamp_ntz"), made))
    if fmt is None:
        return F.try_to_timestamp(s).cast("timestamp_ntz")
    return F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz")


# --------------------------------------------------------------------------- dates
def month_floor(ts) -> Column:
    """first day of the month as a DATE (format only at the end)."""
    return F.trunc(col_(ts).cast("date"), "MM")


def month_label(d) -> Column:
    """'yyyy-MM' label of a date."""
    return F.date_format(col_(d), "yyyy-MM")


def month_offset(start, end) -> Column:
    """whole months from ``start`` to ``end`` (both first-of-month dates)."""
    s, e = col_(start), col_(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def days_between(later, earlier) -> Column:
    """MySQL DATEDIFF(later, earlier): calendar days, time of day ignored."""
    return F.datediff(col_(later).cast("date"), col_(earlier).cast("date"))


# --------------------------------------------------------------------------- numbers
def as_int(cond) -> Column:
    """Boolean as 0/1 with NULL kept (MySQL treats TRUE as 1)."""
    return col_(cond).cast("int")


def avg_exact(c, scale: int = 0) -> Column:
    """AVG with MySQL's result scale (input scale + 4), exact and rounded half up."""
    return F.avg(col_(c).cast(f"decimal(28,{scale})"))


def share_true(cond) -> Column:
    """AVG(condition) = share of TRUE among non-NULL comparisons, scale 4."""
    return avg_exact(as_int(cond), 0)


def dec_div(num, den, scale: int, num_scale: int = 0, den_scale: int = 0) -> Column:
    """num / den rounded half up to ``scale`` digits; NULL when den is 0.

    Operands are cast to decimal(28, num_scale) / decimal(20, den_scale), which keeps at least
    10 + num_scale - den_scale exact digits in Spark's decimal division before the final rounding.
    """
    q = F.try_divide(col_(num).cast(f"decimal(28,{num_scale})"), col_(den).cast(f"decimal(20,{den_scale})"))
    return q.cast(f"decimal(38,{scale})")


def dec_ratio(num, den, scale: int, num_scale: int, den_scale: int) -> Column:
    """Per-row decimal / NULLIF(decimal, 0) rounded half up to ``scale`` digits."""
    q = F.try_divide(col_(num).cast(f"decimal(20,{num_scale})"),
                     F.nullif(col_(den), F.lit(0)).cast(f"decimal(20,{den_scale})"))
    return q.cast(f"decimal(38,{scale})")


def pct(num, den, digits: int, scale: int = 4) -> Column:
    """ROUND(100 * num / den, digits) with the quotient kept at ``scale`` digits first."""
    return publish(F.round(dec_div(F.lit(100) * col_(num), den, scale), digits))


def publish(c) -> Column:
    """Final type of a published ratio or average."""
    return col_(c).cast("double")


def rounded(c, digits: int) -> Column:
    """ROUND half away from zero on an exact value, published as double."""
    return publish(F.round(col_(c), digits))

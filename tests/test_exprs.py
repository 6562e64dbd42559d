import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from shopmarts.functions import exprs


def test_strip_matches_python(spark):
    vals = ["\t Sao Paulo \n", " Rio ", "\x1cx\x1f", "  ", None, "plain"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(exprs.strip_ws("s")).collect()]
    assert got == [v.strip() if v is not None else None for v in vals]
    low = [r[0] for r in df.select(exprs.clean_text("s")).collect()]
    assert low[0] == "sao paulo" and low[4] is None


def test_to_datetime_strict_and_lenient(spark):
    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("bad",), ("",), ("2017-10-02",), (None,)], "s string")
    strict = [r[0] for r in df.select(exprs.to_datetime("s")).collect()]
    assert strict == [dt.datetime(2017, 10, 2, 10, 56, 33), None, None, None, None]
    lenient = [r[0] for r in df.select(exprs.to_datetime("s", None)).collect()]
    assert lenient[3] == dt.datetime(2017, 10, 2)
    assert df.select(exprs.to_datetime("s")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_round_half_up_on_decimals(spark):
    df = spark.createDataFrame([(Decimal("0.285"),), (Decimal("-0.285"),)], "x decimal(10,3)")
    assert [r[0] for r in df.select(exprs.rounded("x", 2)).collect()] == [0.29, -0.29]


def test_scale_plus_four_then_round(spark):
    # 100 * 1/8 = 12.5 -> 12.5000 -> 13 ; 1/3 at scale 4 = 0.3333
    df = spark.createDataFrame([(1, 8), (1, 3), (5, 0)], "a long, b long")
    out = df.select(exprs.pct("a", "b", 0).alias("p"), exprs.dec_div("a", "b", 4).alias("q")).collect()
    assert out[0]["p"] == 13.0 and out[1]["q"] == Decimal("0.3333")
    assert out[2]["p"] is None and out[2]["q"] is None  # zero denominator -> NULL, no error (T7)


def test_share_true_skips_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "b boolean")
    assert df.agg(exprs.share_true("b")).first()[0] == Decimal("0.6667")


def test_days_between_ignores_time(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 1, 2, 0, 0, 1), dt.datetime(2017, 1, 1, 23, 59, 59))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(exprs.days_between("a", "b")).first()[0] == 1


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 10, 31, 23, 0), dt.datetime(2017, 2, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(exprs.month_label(exprs.month_floor("a")).alias("l"),
                  exprs.month_offset(exprs.month_floor("a"), exprs.month_floor("b")).alias("o")).first()
    assert r["l"] == "2016-10" and r["o"] == 4


def test_na_tokens(spark):
    df = spark.createDataFrame([("NA",), ("n/a",), ("",), ("NAN",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(exprs.na_to_null("s")).collect()] == [None, None, None, "NAN", "x", None]


def test_to_datetime_is_zone_free(spark):
    df = spark.createDataFrame([("2017-03-12 02:30:00",), ("2017-02-30 00:00:00",), ("2017-1-02 00:00:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there
        got = [r[0] for r in df.select(exprs.to_datetime("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2017, 3, 12, 2, 30), None, None]


def test_name_and_column_forms_agree(spark):
    """The one-call SQL forms (column name) and the Column forms give the same values."""
    vals = ["2017-10-02 10:56:33", "bad", "", "2017-02-30 00:00:00", "NA", "null", " x ", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    r = df.select(exprs.to_datetime("s").alias("a"), exprs.to_datetime(F.col("s")).alias("b"),
                  exprs.na_to_null("s").alias("c"), exprs.na_to_null(F.col("s")).alias("d")).collect()
    assert [x["a"] for x in r] == [x["b"] for x in r]
    assert [x["c"] for x in r] == [x["d"] for x in r] == ["2017-10-02 10:56:33", "bad", None,
                                                          "2017-02-30 00:00:00", None, None, " x ", None]


def test_to_datetime_takes_what_its_parts_make(spark):
    values = ["2020-02-29 23:59:59", "2021-02-29 00:00:00", "2020-01-01 12:00:60", "2020-01-01 24:00:00", "0000-01-01 00:00:00",
              "9999-12-31 23:59:59", "2020-01-01 00:00:00\n", " 2020-01-01 00:00:00", "2020-13-01 00:00:00", "2020-01-01T00:00:00", None]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    part = lambda at, n: f"try_cast(substring(s, {at}, {n}) AS INT)"
    made = F.expr(f"try_make_timestamp_ntz({part(1, 4)}, {part(6, 2)}, {part(9, 2)}, {part(12, 2)}, {part(15, 2)}, {part(18, 2)})")
    made = F.when(F.col("s").rlike(exprs._TS_SHAPE), made).cast("string")
    for row in df.select("s", made.alias("made"), exprs.to_datetime("s").cast("string").alias("a"), exprs.to_datetime(F.col("s")).cast("string").alias("b")).collect():
        assert row.a == row.made and row.b == row.made, row


def test_strip_takes_every_kind_of_whitespace(spark):
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    values = [f"{c}a{c} b{c}{c}" for c in spaces] + ["".join(spaces), "\u200ba\u200b", "\x1fé\u3000", "a\x00 ", "\ufeffa "]
    df = spark.createDataFrame([(v,) for v in values], "s string")
    assert [r[0] for r in df.select(exprs.strip_ws("s")).collect()] == [v.strip() for v in values]

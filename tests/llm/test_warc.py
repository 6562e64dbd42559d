"""Archives: round trip, revisits, predicates."""
import base64
import glob
import hashlib

import pytest
from pyspark.sql import functions as F

from shopmarts.llm import queries, warc
from tests.llm import brute


def reference(rows):
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, h in rows:
        if i is not None:
            first[digest(h)] = min(i, first.get(digest(h), i))
    out = []
    for i, h in rows:
        d = digest(h)
        again = d in first and i != first[d]
        out.append((i, len((h or "").encode()), d, "revisit" if again else "response", first[d] if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_query(spark):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{brute.SF}/pages.parquet").collect()]
    assert result(queries.op8_warc(spark, brute.SF)) == reference(rows)


@pytest.fixture()
def pages(spark):
    fake = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/\r\nb", fake), (2, None, fake), (2, "u", fake), (3, "u", None), (4, "u", ""), (None, "u", "ü" * 50000), (None, "u", "only null"),
            (7, "u", "ü" * 50000), (8, "v", "plain\n"), (9, "w", "plain\r\n\r\n")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit(1))


def test_awkward_round_trip(spark, pages, tmp_dir):
    rows = [(r.page_id, r.html) for r in pages.collect()]
    assert result(warc.archived_pages(pages, f"{tmp_dir}/a")) == reference(rows)
    assert warc.archived_pages(pages.where("false"), f"{tmp_dir}/e").count() == 0
    back = warc.read_archives(spark, f"{tmp_dir}/a", types="response").collect()
    assert {bytes(r.payload).decode() for r in back} == {h or "" for _, h in rows}


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_predicates_and_skipped_payloads(spark, pages, tmp_dir, compression):
    warc.write_archives(pages, f"{tmp_dir}/a", records_per_file=2, compression=compression)
    assert len(glob.glob(f"{tmp_dir}/a/part-*")) >= 5
    read = lambda **o: warc.read_archives(spark, f"{tmp_dir}/a", **o)
    n = read(types="revisit").count()
    assert 0 < n < read().count() and read(types="revisit,response").count() == 10
    assert read(payload="false").where("payload is not null").count() == 0 and read(payload="false").count() == 10
    assert read(**{"header.WARC-Target-URI": "v"}).count() == 1
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = read().where("record_type = 'revisit'")
        assert df.count() == n
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_small_payloads_are_all_responses(spark, pages, tmp_dir):
    rows = warc.archived_pages(pages, f"{tmp_dir}/m", min_bytes=20).collect()
    assert {r.record_type for r in rows if r.payload_bytes < 20} == {"response"}

import os

import pytest
from pyspark.sql import functions as F

from shopmarts.plans import catalog, mapping
from shopmarts.sources import csv_source
from shopmarts.sources.contracts import BY_TABLE


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_quoted_newline_and_doubled_quotes(spark, tmp_dir):
    c = BY_TABLE["order_reviews"]
    _write(f"{tmp_dir}/{c.file_name()}",
           "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
           "review_answer_timestamp\n"
           'r1,o1,5,NA,"line one\nsaid ""hi"", twice",2018-01-01 00:00:00,2018-01-02 10:00:00\n')
    rows = csv_source.read_contract(spark, tmp_dir, c).collect()
    assert len(rows) == 1
    assert rows[0].review_comment_message == 'line one\nsaid "hi", twice' and rows[0].review_comment_title is None


def test_swapped_header_binds_by_name(spark, tmp_dir):
    c = BY_TABLE["order_payments"]
    _write(f"{tmp_dir}/{c.file_name()}",
           "payment_value,payment_type,order_id,payment_installments,payment_sequential\n12.50,voucher,o1,3,1\n")
    r = csv_source.conform(csv_source.read_contract(spark, tmp_dir, c), c).first()
    assert (r.order_id, r.payment_installments, str(r.payment_value), r.payment_type) == ("o1", 3, "12.50", "voucher")


@pytest.mark.parametrize("header, missing, unexpected", [
    ("product_category_name", ["product_category_name_english"], []),
    ("product_category_name,product_category_name_english,extra", [], ["extra"]),
    ("product_category_name,product_category_name,product_category_name_english", [], None),
])
def test_header_mismatch_is_reported(spark, tmp_dir, header, missing, unexpected):
    c = BY_TABLE["product_category_translation"]
    _write(f"{tmp_dir}/{c.file_name()}", header + "\n" + ",".join("x" * len(header.split(","))) + "\n")
    with pytest.raises(ValueError) as e:
        csv_source.read_contract(spark, tmp_dir, c)
    assert "breaks its contract" in str(e.value)
    for m in missing:
        assert m in str(e.value)
    for u in unexpected or []:
        assert u in str(e.value)


def test_missing_files_are_all_named(spark, tmp_dir):
    mapping.export_raw_files(spark, "/root/testdata/sf0.001", tmp_dir)
    # rename is not used; build a second folder holding only seven of nine files
    only = f"{tmp_dir}-partial"
    for c in list(BY_TABLE.values())[2:]:
        src = f"{tmp_dir}/{c.file_name()}"
        mapping.write_csv(csv_source.read_text(spark, src, c.multiline), f"{only}/{c.file_name()}")
    with pytest.raises(FileNotFoundError) as e:
        csv_source.check_presence(spark, only)
    msg = str(e.value)
    assert "geolocation_dataset.csv" in msg and "customers_dataset.csv" in msg


def test_vendor_prefix(spark):
    c = BY_TABLE["orders"]
    assert c.file_name("acme_") == "acme_orders_dataset.csv"
    assert BY_TABLE["product_category_translation"].file_name("acme_") == "product_category_name_translation.csv"


def test_reject_counts(spark):
    df = spark.createDataFrame([("o1", "x", "p", "s", None, "1.00", "abc"), ("o2", "2", "p", "s", None, "1e12", "2.00")],
                               "order_id string, order_item_id string, product_id string, seller_id string, "
                               "shipping_limit_date string, price string, freight_value string")
    rep = {r.column: r.rejects for r in csv_source.rejects_report(df, BY_TABLE["order_items"]).collect()}
    assert rep == {"order_item_id": 1, "price": 1, "freight_value": 1}


def test_utf8_bom_header(spark, tmp_dir):
    c = BY_TABLE["product_category_translation"]
    with open(f"{tmp_dir}/{c.file_name()}", "w", encoding="utf-8-sig") as f:
        f.write("product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n")
    r = csv_source.read_contract(spark, tmp_dir, c).first()
    assert r.product_category_name == "beleza_saude"


def test_every_part_file_binds_by_its_own_header(spark, tmp_dir):
    c = BY_TABLE["order_payments"]
    folder = f"{tmp_dir}/{c.file_name()}"
    _write(f"{folder}/part-0.csv", "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,voucher,3,5.00\n")
    _write(f"{folder}/part-1.csv", "order_id,payment_installments,payment_type,payment_sequential,payment_value\no2,7,voucher,2,6.00\n")
    rows = {r.order_id: r for r in csv_source.read_contract(spark, tmp_dir, c).collect()}
    assert (rows["o1"].payment_sequential, rows["o1"].payment_installments) == ("1", "3")
    assert (rows["o2"].payment_sequential, rows["o2"].payment_installments) == ("2", "7")


def test_one_wrong_header_in_a_folder_is_reported(spark, tmp_dir):
    c = BY_TABLE["product_category_translation"]
    folder = f"{tmp_dir}/{c.file_name()}"
    _write(f"{folder}/part-0.csv", "product_category_name,product_category_name_english\na,b\n")
    _write(f"{folder}/part-1.csv", "product_category_name,english\nc,d\n")
    with pytest.raises(ValueError, match="english"):
        csv_source.read_contract(spark, tmp_dir, c)


def test_surplus_fields_are_marked_and_short_rows_filled(spark, tmp_dir):
    c = BY_TABLE["product_category_translation"]
    _write(f"{tmp_dir}/{c.file_name()}", 'product_category_name,product_category_name_english\na,b\nc,d,\ne\n"f,g",h\ni,j,k,l\n')
    rows = {r.product_category_name: r for r in csv_source.read_contract(spark, tmp_dir, c, surplus=True).collect()}
    assert {k for k, r in rows.items() if r[csv_source.SURPLUS]} == {"c", "i"}
    assert rows["e"].product_category_name_english is None and rows["f,g"].product_category_name_english == "h"


def test_empty_folder_is_missing(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/{BY_TABLE['orders'].file_name()}")
    report = {r.file_name: r for r in csv_source.presence_report(spark, tmp_dir, [BY_TABLE["orders"]]).collect()}
    assert not report["orders_dataset.csv"].present and report["orders_dataset.csv"].rows is None
    with pytest.raises(FileNotFoundError):
        csv_source.check_presence(spark, tmp_dir, [BY_TABLE["orders"]])


def test_raw_files_are_written_by_as_many_tasks_as_their_rows_come_from(spark, tmp_dir, monkeypatch):
    c = BY_TABLE["order_reviews"]
    rows = spark.range(0, 60, 1, 6).select(*[F.col("id").cast("string").alias(x) for x in c.columns[:-1]],
                                           F.when(F.col("id") % 2 == 0, F.concat("id", F.lit('a "q"\n,b'))).alias(c.columns[-1]))
    monkeypatch.setattr(mapping, "raw_frames", lambda *_: {c.table: rows})
    mapping.export_raw_files(spark, "", f"{tmp_dir}/all")
    raw_dir, _ = catalog._exported(spark, "", c.table)
    for folder in (f"{tmp_dir}/all", raw_dir):
        read = csv_source.read_contract(spark, folder, c, ordinal=False)
        assert len(read.select(c.columns[0]).inputFiles()) == 6
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, rows.collect()))


def test_finished_lines_are_written_where_they_are(spark, tmp_dir):
    lines = spark.range(0, 100, 1, 9).select(F.concat_ws(",", "id", F.lit("x")).alias("value"))
    mapping.write_lines(lines, "k,v", f"{tmp_dir}/lines")
    heads = csv_source.file_headers(spark, f"{tmp_dir}/lines")
    assert list(heads) == [("k", "v")] and len(heads["k", "v"]) == 10  # one of them for the header alone
    read = csv_source.read_text(spark, f"{tmp_dir}/lines", columns=("k", "v"))
    assert sorted(int(r.k) for r in read.collect()) == list(range(100))
    mapping.write_lines(lines.where("false"), "k,v", f"{tmp_dir}/none")
    assert list(csv_source.file_headers(spark, f"{tmp_dir}/none")) == [("k", "v")]
    assert csv_source.read_text(spark, f"{tmp_dir}/none", columns=("k", "v")).count() == 0


def test_raw_files_are_exported_side_by_side(spark, tmp_dir, monkeypatch):
    import threading

    both = threading.Barrier(2, timeout=20)
    monkeypatch.setattr(mapping, "raw_frames", lambda *_: {"orders": None, "customers": None})
    monkeypatch.setattr(mapping, "write_raw", lambda df, path: both.wait())
    paths = mapping.export_raw_files(spark, "", f"{tmp_dir}/all")
    assert paths == {t: f"{tmp_dir}/all/{BY_TABLE[t].file_name()}" for t in ("orders", "customers")}

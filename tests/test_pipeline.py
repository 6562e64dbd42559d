import os

import pytest
from pyspark.sql import functions as F

from shopmarts.operators import clean
from shopmarts.operators.quality import QualityError
from shopmarts.plans import mapping, pipeline
from shopmarts.sources import parquet_sink
from shopmarts.sources.contracts import BY_TABLE
from tests.conftest import SF_SMALL


def _digest(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()


def test_run_twice_same_warehouse(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/wh"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    r1 = pipeline.run_pipeline(spark, raw, out)
    assert all(r.ok for r in r1.reconciliation) and not any(q.violations for q in r1.quality)
    first = {t: _digest(spark.read.parquet(f"{parquet_sink.run_dir(out, r1.run_id)}/{t}")) for t in BY_TABLE}
    r2 = pipeline.run_pipeline(spark, raw, out)
    assert parquet_sink.current_run(spark, out) == r2.run_id
    second = {t: _digest(df) for t, df in pipeline.warehouse(spark, out).items()}
    assert first == second


def test_bad_purchase_timestamp_fails_before_publish(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/wh"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    c = BY_TABLE["orders"]
    src = spark.read.option("header", True).csv(f"{raw}/{c.file_name()}")
    bad = src.withColumn("order_purchase_timestamp",
                         F.when(F.col("order_id").cast("long") % 50 == 0, F.lit("garbage"))
                         .otherwise(F.col("order_purchase_timestamp")))
    mapping.write_csv(bad, f"{tmp_dir}/raw2/{c.file_name()}")
    for other in BY_TABLE.values():
        if other.table != "orders":
            mapping.write_csv(spark.read.option("header", True).option("multiLine", other.multiline)
                              .option("escape", '"').csv(f"{raw}/{other.file_name()}"),
                              f"{tmp_dir}/raw2/{other.file_name()}")
    with pytest.raises(QualityError) as e:
        pipeline.run_pipeline(spark, f"{tmp_dir}/raw2", out)
    assert "orders.order_purchase_timestamp not_null" in str(e.value)
    with pytest.raises(FileNotFoundError):
        parquet_sink.current_run(spark, out)  # nothing was published
    assert os.listdir(f"{out}/runs") == []  # and the failed run's files are gone


def test_row_counts_before_after(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/wh"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    res = pipeline.run_pipeline(spark, raw, out)
    before, after, dropped = res.row_counts["order_reviews"]
    assert before == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count() and after < before
    assert all(read == kept + gone for read, kept, gone in res.row_counts.values()) and dropped == before - after
    g_before, g_after, _ = res.row_counts["geolocation"]
    assert g_after == 25 and g_before > g_after
    assert res.rejects["order_items"] == {"order_item_id": 0, "price": 0, "freight_value": 0}


def test_header_only_files_publish_empty_typed_tables(spark, tmp_dir):
    from shopmarts.sources.contracts import CONTRACTS

    raw = f"{tmp_dir}/raw"
    for c in CONTRACTS:
        os.makedirs(raw, exist_ok=True)
        with open(f"{raw}/{c.file_name()}", "w") as f:
            f.write(",".join(c.columns) + "\n")
    res = pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")
    wh = pipeline.warehouse(spark, f"{tmp_dir}/wh")
    assert all(r.loaded == 0 and r.ok for r in res.reconciliation)
    assert wh["orders"].schema == BY_TABLE["orders"].schema


def test_orphan_item_fails_with_named_reference(spark, tmp_dir):
    from shopmarts.operators import quality

    t = {
        "orders": spark.createDataFrame([("o1", "c1")], "order_id string, customer_id string"),
        "order_items": spark.createDataFrame([("o1", 1), ("o9", 1), (None, 2)], "order_id string, order_item_id int"),
    }
    rows = quality.quality_report(t).collect()
    fk = [r for r in rows if r.check == "foreign_key->orders" and r.table == "order_items"]
    assert fk and fk[0].violations == 1  # NULL references are not orphans; o9 is
    with pytest.raises(QualityError) as e:
        quality.enforce(rows)
    assert "order_items.order_id foreign_key->orders: 1" in str(e.value)


def _raw_with(spark, tmp_dir, table, name, change):
    """All raw files, one of them changed."""
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/{name}"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    for c in BY_TABLE.values():
        df = csv_read(spark, f"{raw}/{c.file_name()}", c)
        if c.table == table:
            change(df, f"{out}/{c.file_name()}")
        else:
            mapping.write_csv(df, f"{out}/{c.file_name()}")
    return out


def csv_read(spark, path, c):
    return spark.read.option("header", True).option("multiLine", c.multiline).option("escape", '"').csv(path)


def test_unreadable_value_fails_unless_allowed(spark, tmp_dir):
    first = F.col("product_id") == "1"
    raw = _raw_with(spark, tmp_dir, "products", "bad", lambda df, path: mapping.write_csv(
        df.withColumn("product_weight_g", F.when(first, F.lit("heavy")).otherwise(F.col("product_weight_g"))), path))
    with pytest.raises(QualityError, match="products.product_weight_g type: 1"):
        pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")
    res = pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh", allow_rejects=True)
    assert res.rejects["products"]["product_weight_g"] == 1


def test_surplus_field_fails(spark, tmp_dir):
    c = BY_TABLE["sellers"]
    raw = _raw_with(spark, tmp_dir, "sellers", "wide", lambda df, path: mapping.write_lines(
        df.select(F.concat_ws(",", "seller_id", "seller_zip_code_prefix", F.lit("x"), F.lit("SP"),
                              F.when(F.col("seller_id") == "3", "more")).alias("value")), ",".join(c.columns), path))
    with pytest.raises(QualityError, match=r"sellers.\* surplus_fields: 1"):
        pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")


def test_a_crash_before_the_marker_leaves_the_old_run(spark, tmp_dir, monkeypatch):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/wh"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    first = pipeline.run_pipeline(spark, raw, out)
    with monkeypatch.context() as m:
        m.setattr(parquet_sink, "publish", lambda *a, **_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            pipeline.run_pipeline(spark, raw, out)
    assert parquet_sink.current_run(spark, out) == first.run_id
    assert pipeline.warehouse(spark, out)["orders"].count() == first.row_counts["orders"][1]
    last = pipeline.run_pipeline(spark, raw, out, keep_runs=1)
    assert parquet_sink.current_run(spark, out) == last.run_id and not os.path.exists(f"{out}/runs/{first.run_id}")


def test_rerun_with_other_partitions_is_bit_equal(spark, tmp_dir):
    raw, out = f"{tmp_dir}/raw", f"{tmp_dir}/wh"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    one = pipeline.run_pipeline(spark, raw, out)
    other = spark.newSession()
    other.conf.set("spark.sql.shuffle.partitions", "13")
    other.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    two = pipeline.run_pipeline(other, raw, out)
    for t in BY_TABLE:
        assert _digest(spark.read.parquet(f"{parquet_sink.run_dir(out, one.run_id)}/{t}")) == _digest(
            spark.read.parquet(f"{parquet_sink.run_dir(out, two.run_id)}/{t}")), t


def test_a_scan_that_counted_twice_is_counted_again(spark, tmp_dir, monkeypatch):
    """An executor that is lost after its map stage makes the stage run, and its scan count, again."""
    raw = f"{tmp_dir}/raw"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    once = pipeline.scanned_rows
    monkeypatch.setattr(pipeline, "scanned_rows", lambda o: {t: 2 * n for t, n in once(o).items()})
    res = pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")
    assert not any(r.violations for r in res.quality)
    assert res.row_counts["order_reviews"][0] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


@pytest.mark.parametrize("table", ["geolocation", "order_reviews", "customers"])
def test_a_lost_record_is_found_in_every_table(spark, tmp_dir, monkeypatch, table):
    raw = f"{tmp_dir}/raw"
    mapping.export_raw_files(spark, SF_SMALL, raw)
    key = BY_TABLE[table].key[0]
    whole = clean.transform_all

    def lossy(frames, collation=None):
        some = frames[table].where(F.col(key).cast("long") % 7 != 0)
        return whole({**frames, table: some}, collation)

    monkeypatch.setattr(clean, "transform_all", lossy)
    with pytest.raises(QualityError, match=f"{table}.* rows_kept"):
        pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")


def test_rows_without_a_key_are_dropped_and_booked(spark, tmp_dir):
    raw = _raw_with(spark, tmp_dir, "geolocation", "nokey", lambda df, path: mapping.write_csv(
        df.unionByName(df.limit(9).withColumn("geolocation_zip_code_prefix", F.lit(None).cast("string"))), path))
    before = spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    res = pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh")
    assert res.row_counts["geolocation"] == (before + 9, 25, before + 9 - 25)
    assert pipeline.warehouse(spark, f"{tmp_dir}/wh")["geolocation"].where("geolocation_zip_code_prefix is null").isEmpty()


def test_books_are_counted_behind_the_last_exchange(spark, tmp_dir):
    """What is booked is summed in the write's own stage, whose updates count once however often it is tried."""
    from pyspark.sql import Observation

    df = spark.range(100).selectExpr("id % 7 AS order_id", "id AS x", "1L AS _book_rows")
    rows = parquet_sink._closed_books(clean.keep_latest(df, ["order_id"], "x").repartition(3, "order_id"), Observation("o"))
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange") and "_book_rows" not in rows.columns


def test_quarantine_names_value_and_place(spark, tmp_dir):
    first = F.col("product_id") == "1"
    raw = _raw_with(spark, tmp_dir, "products", "bad", lambda df, path: mapping.write_csv(
        df.withColumn("product_weight_g", F.when(first, "heavy").otherwise(F.col("product_weight_g"))), path))
    res = pipeline.run_pipeline(spark, raw, f"{tmp_dir}/wh", allow_rejects=True)
    assert set(res.quarantine) == {"products"}
    row = spark.read.parquet(res.quarantine["products"]).first()
    assert (row.table, row.column, row.reason, row.value) == ("products", "product_weight_g", "not double", "heavy")
    assert '"product_id":"1"' in row.record and row.file.endswith(".csv") and row.block == 0 and row.place >= 0
    with pytest.raises(QualityError):
        pipeline.run_pipeline(spark, raw, f"{tmp_dir}/failed")
    assert len(os.listdir(f"{tmp_dir}/failed/quarantine")) == 1  # stays for a look, though the run's files are gone


def test_the_second_run_has_other_splits_but_not_ever_more(spark, tmp_dir, monkeypatch):
    """One split for every 256 KB made tens of thousands of tasks of a few GB."""
    from shopmarts.plans import catalog

    class Seen(Exception):
        pass

    def second(session, *_):
        seen.append(session)
        raise Seen

    seen = []
    monkeypatch.setattr(catalog, "_pipeline_run", lambda *_: ("raw", "out", None))
    monkeypatch.setattr(catalog.pipeline, "run_pipeline", second)
    with pytest.raises(Seen):
        catalog.q_sink_overwrite_idempotent(spark, SF_SMALL)
    with open(f"{tmp_dir}/lines.txt", "w") as f:
        f.write(("x" * 1023 + "\n") * (24 << 10))
    splits = [s.read.text(f"{tmp_dir}/lines.txt").rdd.getNumPartitions() for s in (spark, seen[0])]
    cores = spark.sparkContext.defaultParallelism
    assert splits[0] < splits[1] <= 3 * cores + 2
    assert seen[0].conf.get("spark.sql.shuffle.partitions") != spark.conf.get("spark.sql.shuffle.partitions")

"""What a run leaves on disk, and for how long."""
import gzip
import os
import time

import pytest

from shopmarts.plans import catalog, mapping, pipeline
from shopmarts.session import FREE_SHUFFLES_CONF, freed_shuffles
from shopmarts.sources import csv_source, parquet_sink
from shopmarts.sources.contracts import BY_TABLE
from tests.conftest import SF_SMALL


def _files(folder):
    return {f"{d}/{f}" for d, _, names in os.walk(folder) for f in names}


def _shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    return {f for d in env.blockManager().diskBlockManager().localDirs() for f in _files(str(d)) if "/shuffle_" in f}


def _data_files(folder):
    return [f for f in _files(folder) if os.path.basename(f).startswith("part-")]


def test_shuffle_files_go_with_their_execution(spark, tmp_dir):
    before = _shuffle_files(spark)
    mapping.export_raw_files(spark, SF_SMALL, f"{tmp_dir}/raw")
    pipeline.run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/wh")
    end = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < end:  # executors remove them on a message
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before


def test_the_setting_is_as_before_afterwards(spark):
    was = spark.conf.get(FREE_SHUFFLES_CONF, "false")
    with pytest.raises(KeyError), freed_shuffles(spark):
        assert spark.conf.get(FREE_SHUFFLES_CONF) == "true"
        raise KeyError
    assert spark.conf.get(FREE_SHUFFLES_CONF) == was


def test_a_frame_can_be_executed_twice_with_its_shuffles_freed(spark):
    with freed_shuffles(spark):
        df = spark.range(1000).repartition(3, "id").groupBy("id").count()
        assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 1000


def test_items_are_numbered_before_they_are_text(spark):
    plan = mapping.raw_frames(spark, SF_SMALL)["order_items"]._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Window [", 1)
    assert "as string" in above and "as string" not in below  # what is below the window is shuffled


def test_gzipped_raw_files_have_the_same_records_in_files_of_a_bounded_number(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(mapping, "GZIP_RECORDS", 700)
    gzipped = ("order_reviews", "order_items", "customers")
    mapping.export_raw_files(spark, SF_SMALL, f"{tmp_dir}/plain")
    mapping.export_raw_files(spark, SF_SMALL, f"{tmp_dir}/packed", gzipped=gzipped)
    for t, c in BY_TABLE.items():
        plain, packed = (csv_source.read_contract(spark, f"{tmp_dir}/{d}", c, ordinal=False) for d in ("plain", "packed"))
        assert plain.exceptAll(packed).isEmpty() and packed.exceptAll(plain).isEmpty(), t
        files = _data_files(f"{tmp_dir}/packed/{c.file_name()}")
        assert all(f.endswith(".csv.gz") for f in files) == (t in gzipped), t
        if t in gzipped:
            assert sum(map(os.path.getsize, files)) < sum(map(os.path.getsize, _data_files(f"{tmp_dir}/plain/{c.file_name()}"))) / 2
        if t == "order_items":
            assert len(files) > 6000 // 700 and max(len(gzip.open(f).readlines()) for f in files) == 701
    a, b = (pipeline.run_pipeline(spark, f"{tmp_dir}/{d}", f"{tmp_dir}/wh-{d}") for d in ("plain", "packed"))
    assert a.row_counts == b.row_counts


def _run_in(monkeypatch, base):
    """Which raw files there are when a run begins, by table."""
    seen, run = [], pipeline.run_pipeline
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: base)

    def watched(spark, raw, out):
        seen.append({t: {f.rpartition(".")[2] for f in _data_files(f"{raw}/{c.file_name()}")} for t, c in BY_TABLE.items()})
        return run(spark, raw, out)

    monkeypatch.setattr(catalog.pipeline, "run_pipeline", watched)
    return seen


@pytest.mark.parametrize("name", ["pipeline_row_counts", "reconcile_counts", "pipeline_end_to_end", "load_order"])
def test_raw_files_go_when_their_only_run_is_done(spark, tmp_dir, monkeypatch, name):
    seen = _run_in(monkeypatch, tmp_dir)
    assert catalog.QUERIES[name](spark, SF_SMALL).count() > 8
    assert not os.path.exists(f"{tmp_dir}/raw")
    assert {t for t, kinds in seen[0].items() if kinds == {"gz"}} == {*catalog._ROW_BY_ROW, "order_reviews"}


def test_both_runs_read_files_that_can_be_split_where_splits_count(spark, tmp_dir, monkeypatch):
    seen = _run_in(monkeypatch, tmp_dir)
    rows = catalog.q_sink_overwrite_idempotent(spark, SF_SMALL).collect()
    assert len(rows) == 9 and all(r.identical for r in rows)
    assert seen[0] == seen[1] and {t for t, kinds in seen[0].items() if kinds == {"csv"}} == {"geolocation", "product_category_translation", "order_reviews"}
    assert not os.path.exists(f"{tmp_dir}/raw")


def test_published_files_are_compressed_tightly(spark, tmp_dir):
    mapping.export_raw_files(spark, SF_SMALL, f"{tmp_dir}/raw")
    result = pipeline.run_pipeline(spark, f"{tmp_dir}/raw", f"{tmp_dir}/wh")
    assert all(".zstd." in f for f in _data_files(parquet_sink.run_dir(f"{tmp_dir}/wh", result.run_id)))

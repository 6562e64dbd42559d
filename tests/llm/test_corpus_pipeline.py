"""Every stage against a plain restatement on what the stage before it kept."""
from collections import Counter

import pytest

import corpus_pipeline
from shopmarts.llm import mixing, pii, quality, queries
from shopmarts.llm.stored import stored
from tests.llm import brute
from tests.llm.test_near_dedup import reference
from tests.llm.test_packing import held


def test_stages_in_order(spark):
    stage = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{brute.SF}/documents.parquet")
    columns = docs.columns

    kept = stored(stage["quality_rules"](spark, docs, brute.SF), "test")
    verdict = {r.doc_id: r.kept for r in queries.op4_quality_rules(spark, brute.SF).collect()}
    assert kept.columns == columns and Counter(map(tuple, kept.collect())) == Counter(tuple(r) for r in docs.collect() if verdict[r.doc_id])

    single = stored(stage["near_duplicates"](spark, kept, brute.SF), "test")
    groups = {doc: c for doc, _, c in reference([(r.doc_id, r.text) for r in kept.collect()])}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == {d for d, c in groups.items() if d == c}

    clean = stored(stage["personal_data"](spark, single, brute.SF), "test")
    before = {r.doc_id: r for r in single.collect()}
    for r in clean.collect():
        assert r.text == pii.redact(before[r.doc_id].text) and r.n_chars == len(r.text) and r.source == before[r.doc_id].source
        assert not pii.find(r.text)[1]

    mixed = stored(stage["source_mix"](spark, clean, brute.SF), "test")
    times = {r.doc_id: r.taken // r.size for r in mixing.mixture(clean).collect()}
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == Counter({d: n for d, n in times.items() if n})

    held(stage["packing"](spark, mixed, brute.SF).collect(), [(r.doc_id, r.text) for r in mixed.collect()])


@pytest.mark.parametrize("table", [brute.awkward, brute.empty])
def test_awkward_tables_pass_every_stage(spark, table):
    docs = table(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, brute.SF), "test")
        assert name == "packing" or out.columns == docs.columns
        docs = out


def test_the_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, brute.SF).collect()
    assert sum(r.length for r in rows) > 0 and len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert quality.CONTENT_SHARE == 0.5 and [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules"

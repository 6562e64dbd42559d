"""Corpus pipeline: quality rules, near-duplicate removal, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet below
the session's shared folder and reads back as the next stage's ``docs``. All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopmarts.llm import mixing, near_dedup, packing, pii, quality
from shopmarts.llm.queries import public_tokenizer
from shopmarts.session import release_scratch, remove_path, scratch_mark, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.distinct_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return pii.redacted_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences."""
    return packing.packed(docs, public_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", pack),
]

# Model decisions, sketches and tokenizer ids are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the tables of a stage and its input are removed once its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), ()
    for name, stage in STAGES:
        mark = scratch_mark()
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        release_scratch(mark, keep=(path,))
        for folder in before:
            remove_path(spark, folder)
        before = (path,)
    return docs

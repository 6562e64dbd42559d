"""The query of every operator, over its whole tables, and the SQL of those that SQL can state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmarts.llm import bpe, embedding_dedup, infilling, langid, mixing, near_dedup, packing, pii, quality, suffix_dedup, toxicity, warc, whitening
from shopmarts.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of an installed public tokenizer file (the same on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark, sf_dir):
    return suffix_dedup.without_repeats(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_packing(spark, sf_dir):
    return packing.packed(_table(spark, sf_dir, "documents"), public_tokenizer())


def op4_quality_rules(spark, sf_dir):
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_source_mixing(spark, sf_dir):
    return mixing.mixture(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_near_embeddings(spark, sf_dir):
    return embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))


def op8_warc(spark, sf_dir):
    return warc.archived_pages(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op9_personal_data(spark, sf_dir):
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op10_language(spark, sf_dir):
    return langid.languages(_table(spark, sf_dir, "documents"))


def op11_infilling(spark, sf_dir):
    rows = infilling.infilled(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(infilling.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_whitening(spark, sf_dir):
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def op13_bpe(spark, sf_dir):
    rows = bpe.coded(_table(spark, sf_dir, "documents"), public_tokenizer())
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_near_duplicates, op3_packing, op4_quality_rules, op5_toxicity, op6_source_mixing, op7_near_embeddings, op8_warc,
        op9_personal_data, op10_language, op11_infilling, op12_whitening, op13_bpe)
}

OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT AS h
  FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT source, source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS place FROM by_source
), weighed AS (
  SELECT *, place % 3 + 1 AS weight, 3 * source_size AS most, sum(source_size) OVER () AS total FROM placed
), levels AS (
  SELECT *, (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level,
         row_number() OVER o AS turn
  FROM weighed WINDOW o AS (ORDER BY most::DOUBLE / weight::DOUBLE, place)
), common AS (
  SELECT arg_min(level, turn) AS level FROM levels WHERE most >= level * weight
), targets AS (
  SELECT source, source_size, least(most::DOUBLE, common.level * weight) AS target FROM weighed, common
), plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM targets
), units AS (
  SELECT source, h, sum(size)::BIGINT AS unit FROM sized GROUP BY source, h
), running AS (
  SELECT *, sum(unit) OVER (PARTITION BY source ORDER BY h) AS upto FROM units
), decided AS (
  SELECT r.source, r.h, p.source_size, p.target, p.passes,
         CASE WHEN upto <= target - passes * source_size THEN 1
              WHEN upto - unit <= target - passes * source_size
                   AND upto - (target - passes * source_size) < (target - passes * source_size) - (upto - unit) THEN 1
              ELSE 0 END AS more
  FROM running r JOIN plans p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT s.doc_id, s.size, d.source_size, d.target, (s.size * (d.passes + d.more))::BIGINT AS taken
FROM sized s JOIN decided d ON s.source IS NOT DISTINCT FROM d.source AND s.h = d.h
"""

OP11_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n, sha256('1:' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents
), dealt AS (
  SELECT *, least(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS a,
         greatest(('0x' || h[1:8])::BIGINT % (n + 1), ('0x' || h[9:16])::BIGINT % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
), parts AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1, n - b) AS suffix FROM dealt
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""

ORACLES: dict[str, str] = {"op6_source_mixing": OP6_SQL, "op11_infilling": OP11_SQL}

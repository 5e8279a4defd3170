"""The queries of this subpackage, one per operator, over whole tables; and SQL for
those results that SQL can express in reasonable time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import licenses
from tessera.llm.dedup_exact import exact_duplicates
from tessera.llm.fingerprints import edited_likeness
from tessera.llm.language_id import held_out_quarter, identify, train
from tessera.llm.mixing import mixture
from tessera.llm.ngram_join import jaccard_components
from tessera.llm.packing import pack
from tessera.llm.suffix_dedup import repeated_spans
from tessera.llm.toxicity import held_out_third, toxicity
from tessera.llm.warc import round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(_table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op4_warc_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out_quarter()))
    return identify(docs, model).select("doc_id", held_out_quarter().alias("held_out"), "lang_pred", "score")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), held_out_third())


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_warc_normalise": op4_warc_normalise,
    "op5_language_id": op5_language_id,
    "op6_license_scan": op6_license_scan,
    "op7_mix_sources": op7_mix_sources,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pack_sequences": op10_pack_sequences,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc_normalise": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
             f AS (SELECT body, min(page_id) AS owner FROM p WHERE octet_length(encode(body)) >= 100 GROUP BY body)
        SELECT page_id, octet_length(encode(p.body)) AS payload_bytes, sha256(p.body) AS payload_digest,
               CASE WHEN owner <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN owner <> page_id THEN owner END AS refers_to
        FROM p LEFT JOIN f ON p.body = f.body""",
    "op6_license_scan": licenses.oracle_sql(),
    "op9_exact_dedup": r"""
        WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                          regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
               row_number() OVER w = 1 AS kept, sha256(body) AS text_sha256
        FROM n WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id)""",
}

"""Registered queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import embedding_dedup, exact_dedup, funnels, langid, license_scan, line_dedup, packing, sentencepiece_scan, simhash, spelling, token_counts, token_records, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _on(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(_table(spark, sf_dir, name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": _on("documents", sentencepiece_scan.encode_digest),
    "op2_line_dedup": _on("pages", line_dedup.line_dedup_digest),
    "op3_embedding_near_dedup": _on("embeddings", embedding_dedup.embedding_dedup),
    "op4_exact_dedup": _on("documents", exact_dedup.exact_dedup),
    "op5_language_id": _on("documents", langid.language_id),
    "op6_packing": _on("documents", packing.pack),
    "op7_token_counts": _on("documents", token_counts.token_counts),
    "op8_token_records": _on("documents", token_records.token_records),
    "op9_license_scan": _on("documents", license_scan.license_scan),
    "op10_simhash_near_dedup": _on("documents", simhash.simhash_dedup),
    "op11_spelling_variants": _on("documents", spelling.spelling_variants),
    "op12_toxicity": lambda spark, sf_dir: toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")),
    "op13_funnels": _on("clicks", funnels.funnel_counts),
}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
          doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
        FROM d
    """,
    "op13_funnels": funnels.ORACLE,
}

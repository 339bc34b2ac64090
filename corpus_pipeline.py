"""A corpus pipeline: language ID, exact dedup, SimHash near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import materialize
from vellum.llm.exact_dedup import exact_dedup
from vellum.llm.langid import language_column, train
from vellum.llm.packing import pack
from vellum.llm.simhash import near_copies

#: A document of a learned language scores at least 1 / (number of languages); below this it is rejected.
LEAST_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without a letter, and those that no language fits, go.

    Each row is judged by its own text, in one pass without a join: rows that repeat an id
    or have none are judged one by one. Very long texts are read whole. Null and empty texts
    go. Without a language to learn from, or in an empty table, nothing stays.
    """
    found = language_column(train(docs))(F.col("text").cast("string"))
    return docs.where((found["lang_pred"] != "und") & (found["score"] >= LEAST_LANGUAGE_SCORE))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id stays.

    Null counts as empty text. Rows that share an id (null is one) stay if one of them does.
    Texts are compared whole. An empty table stays empty; other columns stay as they are.
    """
    return _without_dropped(docs, exact_dedup(docs), "exact")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles, the one with the smallest doc_id stays.

    A pair at 0.8 is found with a probability of 0.997, none below is linked; whole texts count, however long.
    Texts without words are equal to each other; rows with a null id stay. Rows that share an
    id stay if one of them does. An empty table stays empty; other columns stay as they are.
    """
    return _without_dropped(docs, near_copies(docs), "near")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 ids, very long texts over many sequences.

    Null and empty texts are a single end id, repeated or null ids are documents of their own, an
    empty table has no pieces; other columns, whatever their names, are left out.
    """
    return pack(docs)


def _without_dropped(docs: DataFrame, verdicts: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose doc_id has a kept row, with their own columns.

    Only the dropped ids are written and joined: where Spark finds the table small enough it
    is broadcast and no text moves, else both sides are shuffled by doc_id.
    """
    dropped, _ = materialize(verdicts.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select(F.col("doc_id").alias("__dropped")), f"{name}-dropped")
    return docs.join(dropped, F.col("doc_id").eqNullSafe(F.col("__dropped")), "left_anti")


STAGES = [("language_id", language_stage), ("exact_dedup", exact_stage), ("simhash_near_dedup", near_stage), ("packing", packing_stage)]

#: Languages are learned and ids come from a tokenizer, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs, _ = materialize(docs, name)
    return docs

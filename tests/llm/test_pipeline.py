"""The corpus pipeline, stage by stage and as a whole, and the registered SQL."""

import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from vellum.llm import bpe, queries
from test_operators import jaccard_groups


def test_stages_keep_columns_and_decide(spark):
    rows = [(1, "the cat sat on the mat and the dog sat on the rug in the house", "en"), (2, "the cat sat on the mat and the dog sat on the rug in the house", "en"), (3, "le chat et le chien sont dans la maison avec les enfants du voisin", "fr"), (4, None, "en"), (5, "123 456", None), (None, "an other text of some words without any id at all", "en")]
    docs = spark.createDataFrame([(*r, "s", 1, "c") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, keep_id string")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(spark, docs, "")
        assert docs.columns == before, name
    assert {r["doc_id"] for r in docs.collect()} == {2, 3, None}
    assert len(corpus_pipeline.STAGES) == 4


def test_run_equals_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    first = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, spark.read.parquet(f"{sf}/documents.parquet"), sf).collect()}
    last = {}
    for i in sorted(first):
        last[docs[i]] = i
    kept = sorted(last.values())
    _, groups = jaccard_groups([(i, docs[i]) for i in kept])
    want = {i for i, g in groups.items() if i == g}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in got} == want
    t = bpe.encoder(bpe.default_path()).tokenizer
    for r in got:
        ids = [*t.encode(docs[r["doc_id"]], add_special_tokens=False).ids, 1]
        assert r["doc_tokens"] == len(ids) and zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, sf).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())

"""Operator 1, SentencePiece encoding and decoding: a max-plus scan over chunks of giant documents.

A document of at most ``chunk_chars`` characters is one chunk and is segmented directly.
A longer one is cut into chunks that different tasks take. A state at a chunk's border is
how many characters of the piece that crosses it lie beyond. For every pair of entry and
exit states a chunk yields the best score between them: a max-plus matrix. Products are
associative: tasks combine the matrices of a span of chunks each, the spans' products give the best
scores at the spans' beginnings, and from these each span gives those at every border in it. With these a chunk
tells, for each exit state, which entry state the best path comes from; composing these
maps from the end gives each chunk its exit state. Then each chunk is traced back on its own.
Both compositions are associative, and their inputs are as small as the number of states.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vellum.llm.common import batch, binaries, gather, id_text, materialize, rows, text_blocks
from vellum.llm.unigram import NEG, Unigram, UnitCache, default_path, unigram

#: Characters of a chunk, and chunks whose matrices one task combines.
CHUNK_CHARS, SPAN = 1 << 16, 64
#: Bytes of texts that are encoded together: each distinct unit of them once.
BLOCK_BYTES = 1 << 20
_IDS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.binary()), ("n_chunks", pa.int32())])
_IDS_DDL = "doc_id bigint, text string, ids binary, n_chunks int"
_CHUNK = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), ("n_chunks", pa.int32()), ("size", pa.int32()), ("body", pa.string())])


def transfer(model: Unigram, body: str, size: int) -> np.ndarray:
    """Best score from each entry state to each exit state; ``body`` goes on behind the chunk's ``size`` characters."""
    states = model.longest
    best = np.full((max(size + states, len(body) + 1), states), NEG)
    best[range(states), range(states)] = 0.0
    for end, found in enumerate(model.lattice(body)):
        for start, score, _ in found:
            if start < size:
                np.maximum(best[end], best[start] + score, out=best[end])
    return best[size : size + states].T.copy()


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product: through a, then through b."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def border_scores(matrices: list[np.ndarray], start: np.ndarray | None = None) -> list[np.ndarray]:
    """For each chunk the best score of each entry state, from those at the first (by default a document's start in state 0).

    Only the start's row of each prefix product is needed, so a vector goes through the matrices.
    """
    if start is None:
        start = np.where(np.arange(len(matrices[0])) == 0, 0.0, NEG)
    return list(accumulate(matrices[:-1], lambda v, m: (v[:, None] + m).max(axis=0), initial=start))


def _forward(model: Unigram, body: str, size: int, scores: np.ndarray):
    """For each place (start, id) of the best piece that ends there, or None where the path comes from the chunk before."""
    states = model.longest
    best = np.full(max(size + states, len(body) + 1), NEG)
    best[:states] = scores
    best, back = best.tolist(), [None] * len(best)
    for end, found in enumerate(model.lattice(body)):
        for start, score, i in found:
            # Pieces from the chunk before start earlier, so they win ties.
            if start < size and best[start] + score > best[end]:
                best[end], back[end] = best[start] + score, (start, i)
    return best, back


def entry_of_exit(model: Unigram, body: str, size: int, scores: np.ndarray) -> list[int]:
    """For each exit state the entry state of its best path, -1 if there is no path."""
    best, back = _forward(model, body, size, scores)
    out = []
    for state in range(model.longest):
        at = size + state
        if best[at] == NEG:
            out.append(-1)
            continue
        while back[at] is not None:
            at = back[at][0]
        out.append(at)
    return out


def exit_states(maps: list[list[int]]) -> list[int]:
    """Each chunk's exit state, when the last chunk ends in state 0."""
    out = [0]
    for f in reversed(maps[1:]):
        out.append(f[out[-1]])
    return out[::-1]


def trace(model: Unigram, body: str, size: int, scores: np.ndarray, state: int) -> list[int]:
    """The ids of the pieces that start in the chunk, on the best path to its exit state."""
    _, back = _forward(model, body, size, scores)
    out, at = [], size + state
    while back[at] is not None:
        start, i = back[at]
        out.append([i] if i >= 0 else model.unknown(body[start]))
        at = start
    return [i for part in reversed(out) for i in part]


def _decoded(model: Unigram, ids: pa.Array) -> pa.Array:
    """The text of each value's ids, null for null."""
    return pa.array([None if x is None else model.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in ids.to_pylist()], pa.string())


@lru_cache(maxsize=4)
def _id_cache(path: str) -> UnitCache:
    """One cache for each Python worker."""
    model = unigram(path)
    return UnitCache(model, lambda unit: array("I", model.segment(unit)).tobytes(), b"".join)


def _direct(path: str, decoded: bool):
    schema = _IDS.append(pa.field("decoded", pa.string())) if decoded else _IDS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = unigram(path), _id_cache(path)
        for b in text_blocks(batches, limit=BLOCK_BYTES):
            doc_ids, texts = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "text"))
            known, codes, first = cache.coded([model.normalize(t) for t in texts.to_numpy(zero_copy_only=False).tolist()])
            ids = binaries(*gather(known, codes, first, np.dtype("<u4")))
            yield batch(schema, [doc_ids, texts, ids, [1] * len(ids), *([_decoded(model, ids)] if decoded else [])])

    return run


def _chunks(path: str, chunk_chars: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, texts in rows(batches, ["row", "text"], 1):
            model = unigram(path)
            text = model.normalize(texts[0])
            starts = range(0, max(1, len(text)), chunk_chars)
            for k, a in enumerate(starts):
                body = text[a : a + chunk_chars + model.longest - 1]
                yield batch(_CHUNK, [row, [k], [len(starts)], [min(chunk_chars, len(text) - a)], [body]])

    return run


def _each(path: str, extra: list[str], make, out: str, kind: pa.DataType, ddl: str, chunks: DataFrame) -> DataFrame:
    """row, chunk and make(model, body, size, *extra) of every chunk."""
    schema = pa.schema([("row", pa.int64()), ("chunk", pa.int32()), (out, kind)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, chunk, *args in rows(batches, ["row", "chunk", "body", "size", *extra], 1):
            yield batch(schema, [row, chunk, [make(unigram(path), *(x[0] for x in args))]])

    return chunks.mapInArrow(run, f"row bigint, chunk int, {out} {ddl}")


def _per_document(df: DataFrame, column: str, scan, out: str, ddl: str) -> DataFrame:
    """scan the values of a document's chunks, in order: one small value per chunk of one document."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], out: scan(list(pdf[column]))})

    return df.groupBy("row").applyInPandas(run, f"row bigint, chunk int, {out} {ddl}")


def _encode_giants(giants: DataFrame, path: str, chunk_chars: int, span: int) -> DataFrame | None:
    spark = giants.sparkSession
    keyed, _ = materialize(giants.withColumn("row", F.monotonically_increasing_id()), "giant-documents")
    if keyed.isEmpty():
        return None
    chunks, _ = materialize(keyed.select("row", "text").mapInArrow(_chunks(path, chunk_chars), "row bigint, chunk int, n_chunks int, size int, body string"), "giant-chunks")
    # Chunks are few bytes but long work: they are spread by number, which neither a scan of small files nor adaptive execution undoes.
    spread = lambda df: df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row", "chunk")
    chunks = spread(chunks)
    states = unigram(path).longest
    as_matrix = lambda b: np.frombuffer(b).reshape(states, states)
    matrices = _each(path, [], lambda m, body, size: transfer(m, body, size).tobytes(), "matrix", pa.binary(), "binary", chunks)
    matrices, _ = materialize(matrices.withColumn("span", F.floor(F.col("chunk") / span).cast("int")), "giant-matrices")

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        """The product of a span's matrices: spans are combined by different tasks."""
        pdf = pdf.sort_values("chunk")
        return pd.DataFrame({"row": pdf["row"].iloc[:1], "chunk": pdf["span"].iloc[:1], "matrix": [reduce(compose, map(as_matrix, pdf["matrix"])).tobytes()]})

    def inside(pdf: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        """The scores at the borders in a span, from those at its beginning."""
        pdf = pdf.sort_values("chunk")
        found = border_scores(list(map(as_matrix, pdf["matrix"])), np.frombuffer(entry["scores"].iloc[0]))
        return pd.DataFrame({"row": pdf["row"], "chunk": pdf["chunk"], "scores": [s.tobytes() for s in found]})

    products = matrices.groupBy("row", "span").applyInPandas(product, "row bigint, chunk int, matrix binary")
    entries = _per_document(products, "matrix", lambda ms: [s.tobytes() for s in border_scores(list(map(as_matrix, ms)))], "scores", "binary").withColumnRenamed("chunk", "span")
    scores = matrices.groupBy("row", "span").cogroup(entries.groupBy("row", "span")).applyInPandas(inside, "row bigint, chunk int, scores binary")
    scored = spread(materialize(chunks.join(scores, ["row", "chunk"]), "giant-scores")[0])
    maps = _each(path, ["scores"], lambda m, body, size, s: entry_of_exit(m, body, size, np.frombuffer(s)), "entries", pa.list_(pa.int32()), "array<int>", scored)
    exits = _per_document(maps, "entries", lambda fs: exit_states([list(f) for f in fs]), "state", "int")
    traced = _each(path, ["scores", "state"], lambda m, body, size, s, state: np.array(trace(m, body, size, np.frombuffer(s), state), dtype="<u4").tobytes(), "ids", pa.binary(), "binary", scored.join(exits, ["row", "chunk"]))

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        """A document's ids are one value; its parts are put together once."""
        return pd.DataFrame({"row": [pdf["row"].iloc[0]], "ids": [b"".join(pdf.sort_values("chunk")["ids"])], "n_chunks": [len(pdf)]})

    return keyed.join(traced.groupBy("row").applyInPandas(whole, "row bigint, ids binary, n_chunks int"), "row").select("doc_id", "text", "ids", "n_chunks")


def encode(docs: DataFrame, model_path: str | None = None, chunk_chars: int = CHUNK_CHARS, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, decoded: bool = False) -> DataFrame:
    """One row per input row: doc_id, text, ids (little-endian unsigned 32-bit), n_chunks; with ``decoded`` also the ids' text.

    The ids are those of the vocabulary's best unigram segmentation. Null text counts as
    empty: no ids. Ids of documents may repeat or be null. An empty table gives an empty
    result; other columns are ignored. One document's ids are one value, as its text is.
    ``decoded`` is what ``decode`` gives for the ids, made in the same pass over the texts.
    """
    path = model_path or default_path()
    wanted = id_text(docs, id_col, text_col)
    short = wanted.where(F.char_length("text") <= chunk_chars).mapInArrow(_direct(path, decoded), _IDS_DDL + ", decoded string" * decoded)
    giants = _encode_giants(wanted.where(F.char_length("text") > chunk_chars), path, chunk_chars, span)
    if giants is None:
        return short
    return short.unionByName(decode(giants, path) if decoded else giants)


def decode(encoded: DataFrame, model_path: str | None = None, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids (little-endian unsigned 32-bit) in ``out_col``; null for null."""
    path = model_path or default_path()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                texts = _decoded(model, part.column(part.schema.get_field_index(ids_col)))
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, out_col])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out_col, StringType())]))


def encode_digest(docs: DataFrame, model_path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, n_chunks, round_trip (decoding gives the text again)."""
    both = encode(docs, model_path, chunk_chars, decoded=True)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"), "n_chunks", (F.col("decoded") == F.col("text")).alias("round_trip"))

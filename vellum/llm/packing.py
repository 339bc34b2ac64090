"""Operator 6, packing: concatenate and cut.

Pass one writes each document's ids with the number of ids before it in its task, and
sums the ids of every task. A prefix sum over the tasks' totals (one number a task) then
gives each document its place in one global stream, without a shuffle or a sort. Pass two
cuts the stream at every ``length`` ids; a document that crosses a border leaves one
record in each sequence that it touches. Only the last sequence can be short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.bpe import default_path, encoder
from vellum.llm.common import batch, binaries, id_text, materialize, rows

_IDS = pa.schema([("part", pa.int64()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary())])
_PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
_PIECE_DDL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def _encode(path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for b in batches:
            doc_ids, texts = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "text"))
            for first, ids, n in enc.blocks(texts, end_id):
                ends = np.cumsum(n)
                yield batch(_IDS, [np.full(len(n), part), before + ends - n, doc_ids.slice(first, len(n)), n, binaries(ids, n)])
                before += int(ends[-1])

    return run


def _cut(offsets: dict[int, int], length: int, dtype: np.dtype, with_ids: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows(batches, ["part", "before", "doc_id", "n", "ids"]):
            out: list[list] = [[] for _ in _PIECE]
            pieces = []
            for p, before, doc_id, n, ids in zip(*part, strict=True):
                wide = np.frombuffer(ids, dtype=dtype).astype("<u4")
                start, at = 0, offsets[p] + before
                while start < n:
                    offset = at % length
                    take = min(n - start, length - offset)
                    piece = wide[start : start + take].tobytes()
                    for column, x in zip(out, (doc_id, start, take, zlib.crc32(piece), n, at // length, offset), strict=True):
                        column.append(x)
                    if with_ids:
                        pieces.append(piece)
                    start, at = start + take, at + take
            done = batch(_PIECE, out)
            yield pa.RecordBatch.from_arrays([*done.columns, pa.array(pieces, pa.binary())], names=[*_PIECE.names, "ids"]) if with_ids else done

    return run


def pack(docs: DataFrame, length: int = 2048, end_id: int = 1, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    With ``with_ids`` also the piece's ids, as little-endian unsigned 32-bit integers.
    Null and empty texts are a single end id. Ids that repeat or are null are documents of
    their own. The stream follows the input's partitions and the rows in them. An empty
    table gives an empty result; other columns are ignored. The driver gathers one number
    for each input task.
    """
    path = tokenizer_path or default_path()
    table, _ = materialize(id_text(docs, id_col, text_col).mapInArrow(_encode(path, end_id), "part bigint, before bigint, doc_id bigint, n bigint, ids binary"), "token-ids")
    offsets, at = {}, 0
    for r in table.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        offsets[r["part"]], at = at, at + r["n"]
    return table.mapInArrow(_cut(offsets, length, encoder(path).dtype, with_ids), _PIECE_DDL + (", ids binary" if with_ids else ""))

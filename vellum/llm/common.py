"""Helpers shared by the training-data operators: written tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.storage import forget, materialize, new_path, shared_dir  # noqa: F401


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id bigint, text string with null as empty): extra columns never reach an operator."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def rows(batches: Iterable[pa.RecordBatch], columns: list[str], at_a_time: int = 256) -> Iterator[list]:
    """Python lists of the named columns, a bounded number of rows at a time."""
    for batch in batches:
        for i in range(0, batch.num_rows, at_a_time):
            part = batch.slice(i, at_a_time)
            yield [part.column(part.schema.get_field_index(c)).to_pylist() for c in columns]


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def text_blocks(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of at most ``limit`` bytes of text; a longer text is a slice of its own. No text is null."""
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(b.schema.get_field_index(column))).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
            yield b.slice(at, until - at)
            at = until


def gather(known: list[bytes], codes: np.ndarray, first: np.ndarray, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts one after the other, and how many each has: a text's units are ``known[codes]`` from its place in ``first`` on."""
    lengths = np.fromiter(map(len, known), np.int64, len(known)) // dtype.itemsize
    starts, pieces = np.cumsum(lengths) - lengths, lengths[codes]
    where = np.repeat(starts[codes] - np.cumsum(pieces) + pieces, pieces)
    where += np.arange(len(where))
    return np.frombuffer(b"".join(known), dtype)[where], np.add.reduceat(pieces, first)


def binaries(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """One binary value of ``sizes`` ids each, without a copy."""
    edges = np.cumsum(np.r_[0, sizes]) * ids.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(ids)])


def shared_runs(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of two and more consecutive rows with equal key, from batches already sorted by it.

    Keys are integers without nulls. Only the current run is held, so memory is bounded by
    the largest run; a row that is alone costs no Python.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy() for k in key]
        changes = np.zeros(n - 1, bool)
        for c in cols:
            changes |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), n]
        first = tuple(c[0].item() for c in cols)
        if held and first != held_key:
            if sum(x.num_rows for x in held) > 1:
                yield pa.Table.from_batches(held)
            held = []
        held.append(b.slice(0, cuts[1]))
        held_key = first
        if len(cuts) == 2:
            continue
        if sum(x.num_rows for x in held) > 1:
            yield pa.Table.from_batches(held)
        for i in (np.flatnonzero(np.diff(cuts[1:-1]) > 1) + 1).tolist():
            yield pa.Table.from_batches([b.slice(cuts[i], cuts[i + 1] - cuts[i])])
        held, held_key = [b.slice(cuts[-2], n - cuts[-2])], tuple(c[-1].item() for c in cols)
    if sum(x.num_rows for x in held) > 1:
        yield pa.Table.from_batches(held)

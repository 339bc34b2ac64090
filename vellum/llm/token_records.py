"""Operator 8, token-ID output: length-delimited binary records with a separate offset index.

A shard is a file of frames, after a header with the width of an id in bytes. A frame is
the length of its data (8 bytes), the masked checksum of these 8 bytes (4), the data, and
the masked checksum of the data (4). The checksum is CRC-32, rotated right by 15 bits,
plus a constant, so that the checksum of data that hold checksums stays sound. The index
has one entry per record: whether its id is null, the id, the frame's place and the
number of ids; with it a reader can take records in any order.
"""

from __future__ import annotations

import random
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.bpe import default_path, encoder
from vellum.llm.common import batch, id_text, materialize, new_path, rows

MAGIC = b"VLREC001"
HEADER, INDEX = "<8sI", "<?qQQ"
SHARD_BYTES = 32 << 20
_MANIFEST = pa.schema([("shard", pa.int64()), ("records", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())])
_RECORD = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
_RECORD_DDL = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(data: bytes) -> bytes:
    head = struct.pack("<Q", len(data))
    return b"".join((head, struct.pack("<I", masked(head)), data, struct.pack("<I", masked(data))))


def unframe(buffer: bytes, at: int = 0) -> tuple[bytes, int]:
    """The data of the frame at a place, and the place behind it; both checksums must hold."""
    head = buffer[at : at + 8]
    size, (check,) = struct.unpack("<Q", head)[0], struct.unpack_from("<I", buffer, at + 8)
    if masked(head) != check:
        raise ValueError(f"corrupt length at byte {at}")
    data = buffer[at + 12 : at + 12 + size]
    if len(data) != size or masked(data) != struct.unpack_from("<I", buffer, at + 12 + size)[0]:
        raise ValueError(f"corrupt record at byte {at}")
    return data, at + 16 + size


def _fs(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


def _names(folder: str, shard: int) -> tuple[str, str]:
    return f"{folder}/shard-{shard:07d}.rec", f"{folder}/shard-{shard:07d}.idx"


def _write(uri: str, path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, enc = TaskContext.get(), encoder(path)
        filesystem, folder = _fs(uri)
        shard = context.partitionId()
        names = _names(folder, shard)
        drafts = [f"{x}.attempt-{context.taskAttemptId()}" for x in names]
        records = tokens = 0
        out = None
        for b in batches:
            doc_ids, texts = (b.column(b.schema.get_field_index(c)) for c in ("doc_id", "text"))
            if out is None and b.num_rows:
                filesystem.create_dir(folder, recursive=True)
                out, index = (filesystem.open_output_stream(x) for x in drafts)
                out.write(struct.pack(HEADER, MAGIC, enc.dtype.itemsize))
                at = struct.calcsize(HEADER)
            for first, ids, sizes in enc.blocks(texts, end_id):
                low = 0
                for doc_id, n in zip(doc_ids.slice(first, len(sizes)).to_pylist(), sizes.tolist(), strict=True):
                    x = frame(ids[low : low + n].tobytes())
                    out.write(x)
                    index.write(struct.pack(INDEX, doc_id is None, doc_id or 0, at, n))
                    low, at, records, tokens = low + n, at + len(x), records + 1, tokens + n
        if out is not None:
            out.close()
            index.close()
            # Under the final names only whole files stand; another attempt puts the same bytes there.
            # Some file systems refuse to move onto a file, so what an earlier attempt left goes first.
            for draft, name in zip(drafts, names, strict=True):
                if filesystem.get_file_info(name).type != pafs.FileType.NotFound:
                    filesystem.delete_file(name)
                filesystem.move(draft, name)
            yield batch(_MANIFEST, [[shard], [records], [tokens], [at]])

    return run


def write_records(docs: DataFrame, uri: str | None = None, end_id: int = 2, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> tuple[str, DataFrame]:
    """Write all documents in ascending order of id (null first, ties by text) as shards; (folder, manifest).

    The manifest has one row per shard that isn't empty: shard, records, tokens, bytes.
    The folder must be one that all executors share; by default it is in the shared folder.
    Null and empty texts are records of the end id alone.
    """
    spark = docs.sparkSession
    uri = uri or new_path(spark, "token-records")
    wanted = id_text(docs, id_col, text_col)
    size = wanted.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards = max(1, -(-size // shard_bytes), min(spark.sparkContext.defaultParallelism, size >> 20))
    # The text's beginning parts rows that share an id (or have none) and keeps their order.
    dealt = wanted.repartitionByRange(shards, "doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return uri, materialize(dealt.mapInArrow(_write(uri, tokenizer_path or default_path(), end_id), "shard bigint, records bigint, tokens bigint, bytes bigint"), "token-manifest")[0]


def read_index(filesystem: pafs.FileSystem, name: str) -> list[tuple[int | None, int, int]]:
    """(id, place of the frame, number of ids) of each record of a shard."""
    with filesystem.open_input_file(name) as f:
        return [(None if null else i, at, n) for null, i, at, n in struct.iter_unpack(INDEX, f.read())]


def read_shard(filesystem: pafs.FileSystem, folder: str, shard: int, seed: int | None = None, buffer_bytes: int = 4 << 20) -> Iterator[tuple[int, int | None, np.ndarray]]:
    """(number in the shard, id, ids) of each record, in the file's order or shuffled by ``seed``."""
    rec, idx = _names(folder, shard)
    index = read_index(filesystem, idx)
    with filesystem.open_input_file(rec) as f:
        magic, width = struct.unpack(HEADER, f.read(struct.calcsize(HEADER)))
        if magic != MAGIC:
            raise ValueError(f"{rec} isn't a record file")
        dtype = np.dtype(f"<u{width}")
        length = [16 + n * width for _, _, n in index]
        if seed is not None:
            order = list(range(len(index)))
            random.Random(seed).shuffle(order)
            for k in order:
                f.seek(index[k][1])
                yield k, index[k][0], np.frombuffer(unframe(f.read(length[k]))[0], dtype=dtype)
            return
        k = 0
        while k < len(index):
            j, size = k, 0
            while j < len(index) and (j == k or size + length[j] <= buffer_bytes):
                size += length[j]
                j += 1
            f.seek(index[k][1])
            data, at = f.read(size), 0
            for i in range(k, j):
                record, at = unframe(data, at)
                yield i, index[i][0], np.frombuffer(record, dtype=dtype)
            k = j


def _read(uri: str, starts: dict[int, int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, folder = _fs(uri)
        for (shards,) in rows(batches, ["shard"]):
            for shard in shards:
                start, out = starts[shard], []
                for _, doc_id, ids in read_shard(filesystem, folder, shard):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                    if len(out) >= 4096:
                        yield batch(_RECORD, list(map(list, zip(*out, strict=True))))
                        out = []
                if out:
                    yield batch(_RECORD, list(map(list, zip(*out, strict=True))))

    return run


def read_records(spark: SparkSession, uri: str, manifest: DataFrame) -> DataFrame:
    """One row per record, read from the files: doc_id, start (ids before it in all shards), n_tokens, ids_crc32.

    The driver gathers two numbers per shard; one task reads one shard.
    """
    starts, at = {}, 0
    for r in manifest.orderBy("shard").collect():
        starts[r["shard"]], at = at, at + r["tokens"]
    last = max(starts, default=-1) + 1
    shards = spark.range(0, last, 1, max(1, last)).select(F.col("id").alias("shard"))
    if len(starts) != last:
        shards = shards.where(F.col("shard").isin(list(starts)))
    return shards.mapInArrow(_read(uri, starts), _RECORD_DDL)


def token_records(docs: DataFrame, end_id: int = 2, tokenizer_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the records and read them back: doc_id, start, n_tokens, ids_crc32, from the files.

    Null and empty texts are the end id alone. Rows that repeat an id, or have none, are
    records of their own, by text; null ids come first. A very long text is one record.
    The strings of added tokens in a text get the library's default ids. An empty table
    gives an empty result; other columns are ignored.
    """
    uri, manifest = write_records(docs, None, end_id, tokenizer_path, id_col, text_col)
    return read_records(docs.sparkSession, uri, manifest)

"""Operator 4, exact dedup: Grace hash deduplication over complete contents.

Records go to buckets by a hash of their content; the bucket files are Spark's own
shuffle files, so a lost executor only costs a recomputation. Each bucket is read
through an open-addressing table that compares complete contents and holds a bounded
number of bytes. Contents that come when the table is full go, all copies alike, to
the next level, where a new hash seed deals them to more buckets, until none is left.
Before the first shuffle every input task combines its own copies in such a table, so
that a content that a third of all rows share reaches its bucket as one row a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import batch, materialize, rows

TABLE_BYTES = 48 << 20
BUCKET_BYTES = 24 << 20
_GROUP = pa.schema([("h", pa.binary()), ("text", pa.string()), ("top_id", pa.int64()), ("n", pa.int64()), ("full", pa.bool_())])
_GROUP_DDL = "h binary, text string, top_id bigint, n bigint, full boolean"


class ContentTable:
    """Open addressing with linear probing; equality is decided on the complete content."""

    def __init__(self, max_bytes: int):
        self.max_bytes, self.used = max_bytes, 0
        self.mask = 1023
        self.slots = [-1] * (self.mask + 1)
        self.keys: list[tuple[bytes, str]] = []
        self.top: list[int | None] = []
        self.count: list[int] = []

    def add(self, h: bytes, text: str, top: int | None, n: int) -> bool:
        """Fold a record in; False if it is a new content and the table is full."""
        at = int.from_bytes(h[:8], "little") & self.mask
        while (i := self.slots[at]) >= 0:
            if self.keys[i][0] == h and self.keys[i][1] == text:
                if top is not None and (self.top[i] is None or top > self.top[i]):
                    self.top[i] = top
                self.count[i] += n
                return True
            at = (at + 1) & self.mask
        if self.keys and self.used + 2 * len(text) > self.max_bytes:
            return False
        self.slots[at] = len(self.keys)
        self.keys.append((h, text))
        self.top.append(top)
        self.count.append(n)
        self.used += 2 * len(text) + 200
        if 2 * len(self.keys) > self.mask:
            self._grow()
        return True

    def _grow(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for i, (h, _) in enumerate(self.keys):
            at = int.from_bytes(h[:8], "little") & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = i

    def groups(self, with_text: bool) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(self.keys), 512):
            part = self.keys[i : i + 512]
            yield batch(_GROUP, [[h for h, _ in part], [t if with_text else None for _, t in part], self.top[i : i + 512], self.count[i : i + 512], [False] * len(part)])


def _fold(max_bytes: int, with_text: bool):
    """Fold the records of a task into a table; what doesn't fit passes on with full = true.

    Only contents that must still be compared elsewhere leave with their text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(max_bytes)
        for part in rows(batches, ["h", "text", "top_id", "n"]):
            rest = [r for r in zip(*part, strict=True) if not table.add(*r)]
            if rest:
                yield batch(_GROUP, [*map(list, zip(*rest, strict=True)), [True] * len(rest)])
        yield from table.groups(with_text)

    return run


def content_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per distinct content: h (SHA-256), top_id (largest id), n (rows). Null text counts as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    records = docs.select(F.unhex(F.sha2(text, 256)).alias("h"), text.alias("text"), F.col(id_col).cast("bigint").alias("top_id"), F.lit(1).cast("bigint").alias("n"))
    size = docs.select(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, done, level = records.mapInArrow(_fold(table_bytes, True), _GROUP_DDL), None, 0
    while left is not None:
        buckets = max(least, -(-size // bucket_bytes) * 2**level)
        # The level is the seed: contents that met in one bucket part in the next level.
        dealt = left.select("h", "text", "top_id", "n").repartition(buckets, F.xxhash64(F.lit(level), "h"))
        out, _ = materialize(dealt.mapInArrow(_fold(table_bytes, False), _GROUP_DDL), f"grace-{level}")
        done = out.where("not full") if done is None else done.unionByName(out.where("not full"))
        rest = out.where("full")
        size = rest.select(F.sum(F.octet_length("text")).alias("b")).first()["b"]
        left = rest if size is not None else None
        level += 1
    return done.select("h", "top_id", "n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical. The row with the largest id of a group stays.
    Null text counts as empty. A null id never beats another; where all ids of a group
    are null, keep_id is null and its rows stay. Rows that repeat an id and its text
    are all kept or all dropped, and all count in group_size. An empty table gives an
    empty result; other columns are ignored.
    """
    groups = content_groups(docs, id_col, text_col, table_bytes, bucket_bytes)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ids = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("h"))
    return (
        ids.join(groups.select("h", "top_id", "n"), "h")
        .select("doc_id", F.col("top_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("doc_id").cast("bigint").eqNullSafe(F.col("top_id")).alias("kept"), F.lower(F.hex("h")).alias("text_sha256"))
    )

"""Exact de-duplication by Grace hashing over complete texts.

Equal means identical after lower-casing A-Z only; null counts as empty.  Every map task first
folds the equal texts of its own rows, so a text that fills a third of the table reaches its
bucket once per task.  The shuffle deals those records to buckets by content hash.  A bucket goes
through an open-addressing table that compares complete texts; what finds no room is partitioned
to spill files by further hash bits, and each file is treated likewise, until all fit.

Of equal texts the row with the largest doc_id stays.  A null doc_id ranks below every number.
Rows that repeat text and the winning doc_id are indistinguishable: `mark_copies` marks all of
them kept, `drop_copies` lets exactly one through.  An empty table gives an empty result, and
other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import fresh_name, stored

#: Bytes of distinct texts that a table holds before it spills (reduce side) or empties (map side).
TABLE_BYTES = 48 << 20
#: Spill files per level, and hash bits that choose among them.
FAN_OUT_BITS = 4

_RECORD = pa.schema(
    [("bucket", pa.int64()), ("text", pa.binary()), ("top", pa.int64()), ("n", pa.int64()), ("n_top", pa.int64())]
)
RECORD_DDL = "bucket long, text binary, top long, n long, n_top long"
GROUP_DDL = "text_sha256 string, keep_id long, group_size long, n_top long"


def normalise(column: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.fill_null(column, ""))


@arrow_udf(T.StringType())
def text_sha256(column: pa.Array) -> pa.Array:
    """SHA-256 of the normalised text, lowercase hex."""
    texts = normalise(column).cast(pa.binary()).to_pylist()
    return pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())


def content_hash(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


class ContentTable:
    """Open addressing with linear probing; a hit needs equal hash and equal complete text."""

    def __init__(self, most_bytes: int):
        self.most, self.bytes = most_bytes, 0
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.groups: list[list] = []  # top id, rows, rows that have the top id

    def _place(self, h: int, text: bytes) -> int:
        """The slot of an equal text, or the free one where it belongs."""
        mask = len(self.slots) - 1
        i = h & mask
        while (j := self.slots[i]) >= 0:
            if self.hashes[j] == h and self.texts[j] == text:
                break
            i = (i + 1) & mask
        return i

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for j, h in enumerate(self.hashes):
            i = h & mask
            while self.slots[i] >= 0:
                i = (i + 1) & mask
            self.slots[i] = j

    def add(self, h: int, text: bytes, top: int | None, n: int, n_top: int) -> bool:
        """Take the record in; False where the text is new and there is no room (an empty table has room)."""
        i = self._place(h, text)
        if (j := self.slots[i]) >= 0:
            group = self.groups[j]
            group[1] += n
            if top == group[0]:
                group[2] += n_top
            elif group[0] is None or (top is not None and top > group[0]):
                group[0], group[2] = top, n_top
            return True
        if self.texts and self.bytes + len(text) > self.most:
            return False
        self.slots[i] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.groups.append([top, n, n_top])
        self.bytes += len(text) + 200
        if 2 * len(self.texts) > len(self.slots):
            self._grow()
        return True


def _record_batches(table: ContentTable) -> Iterator[pa.RecordBatch]:
    step = 512
    for i in range(0, len(table.texts), step):
        tops, ns, n_tops = zip(*table.groups[i : i + step])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(table.hashes[i : i + step], pa.int64()),
                pa.array(table.texts[i : i + step], pa.binary()),
                pa.array(tops, pa.int64()),
                pa.array(ns, pa.int64()),
                pa.array(n_tops, pa.int64()),
            ],
            schema=_RECORD,
        )


def _fold_own(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """A task's rows (doc_id, text), equal texts folded to one record; the table empties when full."""
    table = ContentTable(most)
    for batch in batches:
        texts = normalise(batch.column(1)).cast(pa.binary()).to_pylist()
        for doc_id, text in zip(batch.column(0).to_pylist(), texts):
            h = content_hash(text)
            if not table.add(h, text, doc_id, 1, 1):
                yield from _record_batches(table)
                table = ContentTable(most)
                table.add(h, text, doc_id, 1, 1)
    yield from _record_batches(table)


def _groups(records: Iterator[tuple], most: int, level: int, folder: str) -> Iterator[tuple]:
    """Groups of two rows or more of one bucket; the records that find no room go to spill files."""
    table, files = ContentTable(most), {}
    shift = 16 + FAN_OUT_BITS * level  # buckets are dealt by the whole hash, tables by its low bits
    for h, text, top, n, n_top in records:
        if not table.add(h, text, top, n, n_top):
            part = (h >> (shift % 60)) & ((1 << FAN_OUT_BITS) - 1)
            if part not in files:
                files[part] = open(os.path.join(folder, f"{level}-{part}-{len(os.listdir(folder))}"), "w+b")
            pickle.dump((h, text, top, n, n_top), files[part], pickle.HIGHEST_PROTOCOL)
    for text, (top, n, n_top) in zip(table.texts, table.groups):
        if n > 1:
            yield hashlib.sha256(text).hexdigest(), top, n, n_top
    del table
    for file in files.values():
        file.seek(0)
        yield from _groups(_spilled(file), most, level + 1, folder)
        file.close()
        os.unlink(file.name)


def _spilled(file) -> Iterator[tuple]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _bucket(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    def records():
        for batch in batches:
            yield from zip(*[column.to_pylist() for column in batch.columns])

    seen: list[tuple] = []
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        for group in _groups(records(), most, 0, folder):
            seen.append(group)
            if len(seen) == 4096:
                yield _group_batch(seen)
                seen = []
    if seen:
        yield _group_batch(seen)


def _group_batch(groups: list[tuple]) -> pa.RecordBatch:
    kinds = {"text_sha256": pa.string(), "keep_id": pa.int64(), "group_size": pa.int64(), "n_top": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*groups), kinds.values())], names=list(kinds)
    )


def copy_groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per text that two rows or more share: text_sha256, keep_id, group_size, n_top (rows with keep_id)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    own = rows.mapInArrow(lambda batches: _fold_own(batches, table_bytes), RECORD_DDL)
    dealt = own.repartition("bucket")
    return dealt.mapInArrow(lambda batches: _bucket(batches, table_bytes), GROUP_DDL)


def mark_copies(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Per row of docs: doc_id, keep_id, group_size, kept, text_sha256."""
    groups = stored(copy_groups(docs, table_bytes), "copies")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_sha256(F.col("text").cast("string")).alias("text_sha256"))
    joined = rows.join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of docs that stay, with all their columns; one row of each text."""
    groups = stored(copy_groups(docs, table_bytes), "copies")
    names = [fresh_name(docs, stem) for stem in ("sha_", "keep_id_", "size_", "n_top_")]
    key, keep, size, n_top = names
    digest = text_sha256(F.col("text").cast("string"))
    tagged = docs.withColumn(key, digest).join(groups.toDF(*names), key, "left")
    kept = tagged.filter(F.col(size).isNull() | F.col("doc_id").cast("long").eqNullSafe(F.col(keep)))
    if not groups.filter("n_top > 1").isEmpty():  # rows that repeat the winner: one of them stays
        single = kept.filter(F.col(n_top).isNull() | (F.col(n_top) == 1))
        kept = single.unionByName(kept.filter(F.col(n_top) > 1).dropDuplicates([key]))
    return kept.select(*docs.columns)

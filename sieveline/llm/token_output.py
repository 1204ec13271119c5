"""Token ids in files of Re-Pair compressed blocks, with random access.

Documents are put in ascending order of doc_id (nulls first, equal ids by a hash of the text), encoded, closed
by an end id and cut into blocks of whole documents.  Per block, frequent pairs of neighbouring
symbols are replaced by nonterminals, round after round until none is frequent; the block stores the remaining symbols,
the rules and the length each rule expands to, so any stretch of ids can be decoded without the
rest.  A block is the binary payload of one row of the output table, which Spark's writer commits
to shared storage; small columns beside it (shard, block, n_ids) are the index.

A literal added token of the file in a text gets its id, as in the library.  A null or empty text has the end id only.  Repeated rows are written as often as they occur.  An
empty table gives files without blocks.  Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.common import new_folder, slices
from sieveline.llm.encoder import default_path, worker_encoder

END_ID = 2
#: Ids per block, reached by whole documents; a longer document is a block of its own.
BLOCK_IDS = 1 << 18
#: A pair is replaced if a block has it so often.
MIN_COUNT = 8
#: Pairs replaced per round at most, unless a quarter of those that are frequent enough is more.
ROUND_RULES = 2048
#: Pairs of a left and a right symbol for which a table is laid out; more are searched for.
CELLS = 1 << 22
MAGIC = b"REPAIR01"

BLOCK_DDL = "shard int, block int, n_docs long, n_ids long, payload binary"


def _found(chosen: np.ndarray, before: np.ndarray, after: np.ndarray, pairs: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (before, after) of symbols below top are chosen, and which of the sorted chosen ones each is."""
    left, right = np.unique(chosen >> 32), np.unique(chosen & 0xFFFFFFFF)
    row, column = np.full(top, -1), np.full(top, -1)
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    maybe = np.flatnonzero((row >= 0)[before] & (column >= 0)[after])
    if len(left) * len(right) > CELLS:
        rule = np.minimum(np.searchsorted(chosen, pairs[maybe]), len(chosen) - 1)
        hit = chosen[rule] == pairs[maybe]
    else:
        cells = np.full(len(left) * len(right), -1, np.int32)
        cells[row[chosen >> 32] * len(right) + column[chosen & 0xFFFFFFFF]] = np.arange(len(chosen))
        rule = cells[row[before[maybe]] * len(right) + column[after[maybe]]]
        hit = rule >= 0
    return maybe[hit], rule[hit]


def compress(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules, lengths): rule i is the pair of symbols that symbol base + i stands for, base being
    the largest id + 1; lengths has the number of ids each rule expands to."""
    s = ids.astype(np.int64)
    base = int(s.max()) + 1 if len(s) else 1
    rules: list[np.ndarray] = []
    sizes = np.zeros(0, np.int64)
    at: np.ndarray | slice = slice(0, max(0, len(s) - 1))  # where a pair stands that may be frequent
    while True:  # every round with frequent pairs makes s shorter
        top = base + len(sizes)
        before, after = s[:-1][at], s[1:][at]
        pairs = before << 32 | after
        kinds, counts = np.unique(pairs, return_counts=True)
        often = np.flatnonzero(counts >= MIN_COUNT)
        if not len(often):
            break
        order = np.lexsort((kinds[often], -counts[often]))[: max(ROUND_RULES, len(often) // 4)]
        chosen = np.sort(kinds[often[order]])
        others = np.delete(kinds[often], order)
        left, right = chosen >> 32, chosen & 0xFFFFFFFF
        maybe, rule = _found(chosen, before, after, pairs, top)
        place = maybe if isinstance(at, slice) else at[maybe]
        # of pairs that overlap in a run, every other one is replaced
        new_run = np.ones(len(place), bool)
        new_run[1:] = np.diff(place) != 1
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(place)), 0))
        keep = (np.arange(len(place)) - run_start) % 2 == 0
        place, rule = place[keep], rule[keep]
        has_place = np.bincount(rule, minlength=len(chosen)) > 0  # rules that found no place are not stored
        used, rule = np.flatnonzero(has_place), (np.cumsum(has_place) - 1)[rule]
        rules.append(chosen[used])
        known = np.concatenate([np.ones(base, np.int64), sizes])
        sizes = np.concatenate([sizes, known[left[used]] + known[right[used]]])
        s[place] = top + rule
        gone = np.ones(len(s), bool)
        gone[place + 1] = False
        s = s[gone]
        # only new symbols can make a pair frequent that was not
        fresh = s >= top
        open_ = fresh[:-1] | fresh[1:]
        if len(others):
            first, second = np.zeros(base + len(sizes), bool), np.zeros(base + len(sizes), bool)
            first[others >> 32], second[others & 0xFFFFFFFF] = True, True
            open_ |= first[s[:-1]] & second[s[1:]]
        at = np.flatnonzero(open_)
    flat = np.concatenate(rules) if rules else np.zeros(0, np.int64)
    return s, np.stack([flat >> 32, flat & 0xFFFFFFFF], axis=1), sizes


def expand(s: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    s = s.astype(np.int64)
    while True:
        deep = s >= base
        if not deep.any():
            return s.astype(np.uint32)
        ends = np.cumsum(1 + deep)
        out = np.empty(ends[-1], np.int64)
        out[ends - 1 - deep] = np.where(deep, rules[np.where(deep, s - base, 0), 0], s) if len(rules) else s
        out[ends[deep] - 1] = rules[s[deep] - base, 1]
        s = out


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype("<u2" if not len(values) or values.max() < 1 << 16 else "<u4")


class Block:
    """A block's payload, opened."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a block of token ids")
        n_docs, n_symbols, n_rules, self.base, wide = np.frombuffer(payload, "<i8", 5, 8).tolist()
        at = 48

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(payload, kind, n, at)
            at += values.nbytes
            return values

        self.doc_ids, self.known = take("<i8", n_docs), take("u1", n_docs)
        self.sizes = take("<u4", n_docs).astype(np.int64)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.symbols = take("<u4" if wide else "<u2", n_symbols)

    @staticmethod
    def pack(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
        symbols, rules, lengths = compress(ids)
        symbols = _narrow(symbols)
        base = int(ids.max()) + 1 if len(ids) else 1
        head = np.array([len(doc_ids), len(symbols), len(rules), base, symbols.dtype.itemsize == 4], "<i8")
        parts = [
            np.array([0 if d is None else d for d in doc_ids], "<i8"),
            np.array([d is not None for d in doc_ids], "u1"),
            np.asarray(sizes, "<u4"),
            lengths.astype("<u4"),
            rules.astype("<u4"),
            symbols,
        ]
        return MAGIC + head.tobytes() + b"".join(p.tobytes() for p in parts)

    def ids(self) -> np.ndarray:
        """All ids; each rule is expanded once and copied to its places."""
        own = np.arange(self.base)
        flat = np.concatenate([own, expand(self.base + np.arange(len(self.rules)), self.rules, self.base)]).astype(np.uint32)
        starts = np.concatenate([own, self.base + np.cumsum(self.lengths) - self.lengths])[self.symbols]
        each = np.concatenate([np.ones(self.base, np.int64), self.lengths])[self.symbols]
        ends = np.cumsum(each)
        return flat[np.repeat(starts - (ends - each), each) + np.arange(each.sum())]

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of the block; only symbols that reach into this range are expanded."""
        s = self.symbols.astype(np.int64)
        each = np.concatenate([np.ones(self.base, np.int64), self.lengths])[s]
        ends = np.cumsum(each)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        found = expand(s[a:b], self.rules, self.base)
        skip = start - (ends[a] - each[a]) if a < len(ends) else 0
        return found[skip : skip + max(0, stop - start)]

    def document(self, k: int) -> np.ndarray:
        """Ids of the block's k-th document."""
        stop = int(self.sizes[: k + 1].sum())
        return self.slice(stop - int(self.sizes[k]), stop)


def _encode_blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int) -> Iterator[pa.RecordBatch]:
    """A task's sorted rows (doc_id, text) as blocks."""
    encoder, shard = worker_encoder(path), TaskContext.get().partitionId()
    doc_ids: list[int | None] = []
    parts: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    held = number = 0

    def block() -> pa.RecordBatch:
        ids = np.concatenate(parts)
        values = [[shard], [number], [len(doc_ids)], [len(ids)], [Block.pack(doc_ids, np.concatenate(sizes), ids)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["shard", "block", "n_docs", "n_ids", "payload"])

    for batch in batches:
        own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in slices([(t or "").encode("utf-8", "replace") for t in texts]):
            ids, n = encoder.encode(texts[a:b])
            ends = np.cumsum(n)
            parts.append(np.insert(ids, ends, np.uint32(end_id)))
            sizes.append(n + 1)
            doc_ids += own[a:b]
            held += len(parts[-1])
            if held >= block_ids:
                yield block()
                doc_ids, parts, sizes, held, number = [], [], [], 0, number + 1
    if doc_ids:
        yield block()


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Encode the documents in ascending doc_id order and write the blocks to a folder of shared storage."""
    path = path or default_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = ["doc_id", "tie"]
    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    blocks = ordered.select("doc_id", "text").mapInArrow(lambda batches: _encode_blocks(batches, path, end_id, block_ids), BLOCK_DDL)
    blocks.write.option("compression", "zstd").parquet(folder)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, number, payload in zip(*[c.to_pylist() for c in batch.columns]):
            block = Block(payload)
            ids = block.ids().astype("<u4")
            ends = np.cumsum(block.sizes)
            crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip((ends - block.sizes).tolist(), ends.tolist())]
            known = pa.array(block.doc_ids, mask=block.known == 0)
            same = [pa.array([x] * len(ends), pa.int32()) for x in (shard, number)]
            arrays = [*same, known, pa.array(ends - block.sizes), pa.array(block.sizes), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the written blocks."""
    blocks = spark.read.schema(BLOCK_DDL).parquet(folder)
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_at"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = blocks.select("shard", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("block_at")).join(shards, "shard")
    found = blocks.select("shard", "block", "payload").mapInArrow(
        _decode, "shard int, block int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return found.join(places, ["shard", "block"]).select(
        "doc_id", (F.col("shard_at") + F.col("block_at") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def write_and_index(docs: DataFrame, path: str | None = None) -> DataFrame:
    folder = new_folder(docs.sparkSession, "token-ids")
    write_ids(docs, folder, path)
    return read_index(docs.sparkSession, folder)

"""Benchmark decontamination by Wu-Manber multi-pattern search.

Words are runs of digits, letters a-z (A-Z lower-cased) and everything beyond ASCII.  A text
becomes its words between single spaces, so a window of ten item words is a byte pattern that
starts and ends with a space and can match whole words only.  The shift table holds, per hashed
block of B bytes, how far the search may jump; blocks that end the first m bytes of a pattern
have shift 0 and lead, by suffix hash, to the few patterns that are then compared directly.
The search runs over many stretches of a slice of texts at once.

The benchmark is the stated query set: it is read in blocks of bounded size and every block is
held against all documents; the documents are not shuffled (with several blocks, hits only).

Null or wordless texts have no words and no hits; a wordless item has no window.  An item of
fewer than ten words is one window.  Rows of one item_id are one item; a null item_id counts as
the empty id.  Empty tables give no rows, or no hits.  Results depend on the text alone, so
repeated rows and other columns change nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import fresh_name, slices, stored, texts_as_bytes

WINDOW = 10
#: Bytes of item text per pattern block; one block's tables are a worker's whole memory for patterns.
BLOCK_BYTES = 4 << 20
#: Bytes of text that one lane of the search walks through.
LANE = 512
#: Patterns shorter than this have a table of their own, so that they don't shorten the jumps of the others.
SHORT = 24

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)

SCAN_TYPE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.IntegerType())),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)
_SCAN_ARROW = pa.struct(
    [("n_words", pa.int64()), ("spans", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
)
RESULT_TYPE = T.StructType(
    [
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
    ]
)
_RESULT_ARROW = pa.struct([("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string())])


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def item_windows(text: bytes | None) -> list[bytes]:
    """An item's windows as patterns."""
    w = words(text)
    if not w:
        return []
    starts = range(max(1, len(w) - WINDOW + 1))
    return [b" " + b" ".join(w[i : i + WINDOW]) + b" " for i in starts]


class WuManber:
    """Finds every occurrence of every pattern."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        need = math.ceil(math.log2(2 * m * len(patterns) + 1) / 2.5)
        self.b = b = max(1, min(need, m, 8))
        self.mask = np.uint64((1 << (8 * b)) - 1)
        self.bits = int(np.clip(math.ceil(math.log2(len(patterns) * m)) + 3, 10, 22))
        heads = np.frombuffer(b"".join(p[:m] + bytes(8) for p in patterns), np.uint8)
        starts = np.arange(len(patterns)) * (m + 8)
        self.shift = np.full(1 << self.bits, m - b + 1, np.int32)
        for q in range(m - b + 1):  # the block that starts at q of each pattern's first m bytes
            np.minimum.at(self.shift, self._slot(self._view(heads)[starts + q]), m - b - q)
        self.buckets: dict[int, list[int]] = defaultdict(list)
        for i, slot in enumerate(self._slot(self._view(heads)[starts + m - b]).tolist()):
            self.buckets[slot].append(i)

    def _view(self, data: np.ndarray) -> np.ndarray:
        """Eight bytes from every position, as one integer."""
        return np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (((blocks & self.mask) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, text: bytes) -> list[tuple[int, int]]:
        """(start, pattern) of every occurrence."""
        last = len(text) - self.b  # where the last block starts
        first = self.m - self.b
        if last < first:
            return []
        view = self._view(np.frombuffer(text + bytes(8), np.uint8))
        at = np.arange(first, last + 1, LANE)
        end = np.minimum(at + LANE, last + 1)
        stops = []
        while len(at):
            slot = self._slot(view[at])
            jump = self.shift[slot]
            zero = jump == 0
            if zero.any():
                stops.append(np.stack([at[zero], slot[zero]]))
            at = at + np.maximum(jump, 1)
            going = at < end
            at, end = at[going], end[going]
        found = []
        for k in stops:
            for position, slot in k.T.tolist():
                start = position - first
                for i in self.buckets[slot]:
                    if text.startswith(self.patterns[i], start):
                        found.append((start, i))
        return found


class PatternBlock:
    """The windows of a block of items and the items they come from."""

    def __init__(self, items: list[tuple[str | None, bytes | None]]):
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item_id, text in items:
            for window in item_windows(text):
                owners[window].add(item_id or "")
        kinds = [[p for p in owners if (len(p) < SHORT) == short] for short in (False, True)]
        self.searches = [WuManber(kind) for kind in kinds if kind]
        self.owners = owners

    def scan(self, texts: list[bytes | None]) -> Iterator[tuple[int, list[int], list[str]]]:
        """Per text: number of words, hit words as flat disjoint (start, end) pairs, ids of its items."""
        split = [words(t) for t in texts]
        starts, parts, at = [], [], 0
        for w in split:
            part = b" ".join(w)
            starts.append(at)
            parts.append(part)
            at += len(part) + 2
        joined = b" " + b"  ".join(parts) + b" "  # two spaces between texts: no window spans them
        hits: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        if at:
            for search in self.searches:
                found = search.find(joined)
                if found:
                    rows = np.searchsorted(starts, [start for start, _ in found], "right") - 1
                    for row, (start, i) in zip(rows.tolist(), found):
                        hits[row].append((start - starts[row], search.patterns[i]))
        for row, w in enumerate(split):
            if row not in hits:
                yield len(w), [], []
                continue
            spaces = np.flatnonzero(np.frombuffer(b" " + parts[row], np.uint8) == 32)
            firsts = np.searchsorted(spaces, [offset for offset, _ in hits[row]]).tolist()
            spans = merge([(a, a + p.count(b" ") - 1) for a, (_, p) in zip(firsts, hits[row])])
            yield len(w), spans, sorted(set().union(*(self.owners[p] for _, p in hits[row])))


def merge(spans: list[tuple[int, int]]) -> list[int]:
    """Half-open ranges as flat, disjoint, ascending pairs."""
    flat: list[int] = []
    for a, b in sorted(spans):
        if flat and a <= flat[-1]:
            flat[-1] = max(flat[-1], b)
        else:
            flat += [a, b]
    return flat


_BUILT: tuple[object, PatternBlock] | None = None


def _built(broadcast) -> PatternBlock:
    """A worker keeps the tables of the block it used last."""
    global _BUILT
    if _BUILT is None or _BUILT[0] != broadcast.name:
        _BUILT = (broadcast.name, PatternBlock(broadcast.value.value))
    return _BUILT[1]


class _Shipped:
    """A broadcast block with a name that workers can compare."""

    def __init__(self, value, name: str):
        self.value, self.name = value, name


def scan_column(block: _Shipped, text: Column) -> Column:
    @arrow_udf(SCAN_TYPE)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        patterns = _built(block)
        for batch in batches:
            texts = texts_as_bytes(batch)
            rows = [r for a, b in slices(texts) for r in patterns.scan(texts[a:b])]
            n, spans, items = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                fields=list(_SCAN_ARROW),
            )

    return scan.asNondeterministic()(text.cast("string"))


@arrow_udf(RESULT_TYPE)
def _digest(spans: pa.Array, items: pa.Array) -> pa.Array:
    n_hit, n_items, shas = [], [], []
    for flat, ids in zip(spans.to_pylist(), items.to_pylist()):
        flat = merge(list(zip(flat[::2], flat[1::2])))
        ids = sorted(set(ids))
        n_hit.append(sum(flat[1::2]) - sum(flat[::2]))
        n_items.append(len(ids))
        shas.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
    return pa.StructArray.from_arrays(
        [pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(shas, pa.string())],
        fields=list(_RESULT_ARROW),
    )


def pattern_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[_Shipped]:
    """The items in broadcast blocks of about block_bytes each."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    context = benchmark.sparkSession.sparkContext
    blocks = []
    for k in range(n):
        rows = [(r[0], None if r[1] is None else bytes(r[1], "utf-8")) for r in items.filter(of == k).collect()]
        sent = context.broadcast(rows)
        blocks.append(_Shipped(sent, f"{context.applicationId}-{id(sent)}-{hash(tuple(rows))}-{k}"))
    return blocks


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with two columns more, in this order behind its own: the struct of the scan and that of its digest."""
    blocks = pattern_blocks(benchmark, block_bytes)
    scan, digest = fresh_name(docs, "scan_"), fresh_name(docs, "digest_")
    if len(blocks) == 1:
        marked = docs.withColumn(scan, scan_column(blocks[0], F.col("text")))
        return marked.withColumn(digest, _digest(F.col(scan)["spans"], F.col(scan)["items"]))
    key = fresh_name(docs, "key_")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    found = None
    for k, block in enumerate(blocks):
        scanned = keyed.select(key, scan_column(block, F.col("text")).alias("s")).filter(F.size("s.spans") > 0)
        part = stored(scanned.select(key, "s.spans", "s.items").dropDuplicates([key]), f"hits-{k}")
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy(key).agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )  # at most one row per block and text
    empty = F.array().cast("array<string>")
    joined = keyed.join(hits.select(key, F.col("spans").alias(scan), F.col("items").alias(digest)), key, "left")
    joined = joined.withColumns({scan: F.coalesce(F.col(scan), empty.cast("array<int>")), digest: F.coalesce(F.col(digest), empty)})
    both = _digest(F.col(scan), F.col(digest))
    n_words = word_count(F.col("text").cast("string"))
    return joined.withColumns(
        {digest: both, scan: F.struct(n_words.alias("n_words"), F.col(scan).alias("spans"), F.col(digest).alias("items"))}
    ).select(*docs.columns, scan, digest)


@arrow_udf(T.LongType())
def word_count(text: pa.Array) -> pa.Array:
    return pa.array([len(words(t)) for t in texts_as_bytes(text)], pa.int64())


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    marked = mark_contaminated(docs.select("doc_id", "text"), benchmark, block_bytes)
    scan, digest = marked.columns[-2:]
    return marked.select(
        "doc_id",
        F.col(scan)["n_words"].alias("n_words"),
        F.col(digest)["n_hit"].alias("n_hit"),
        F.col(digest)["n_items"].alias("n_items"),
        F.col(digest)["items_sha256"].alias("items_sha256"),
        (F.col(digest)["n_hit"] > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs that hold no window of an item."""
    marked = mark_contaminated(docs, benchmark, block_bytes)
    return marked.filter(F.col(marked.columns[-1])["n_hit"] == 0).select(*docs.columns)

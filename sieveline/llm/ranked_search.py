"""Ranked lexical search by MaxScore with bounds for pairs of terms.

The items are the stated query set; all documents are ranked for each.  Items are taken in blocks of
at most ITEM_TERMS terms, and only terms of the block's items are indexed.  One pass over the
documents turns every task's rows into shards of bounded size, each a table row, so documents are not
shuffled.  A shard keeps posting lists (documents in order, with frequencies); when the
frequencies of all shards are added up, impacts replace them: integers that a document's score is
the sum of.

Next to the lists a shard's index has intersection lists of pairs of terms, those that follow each other
when an item's terms are ordered by falling weight, each with the largest joint impact of a document that
holds both.  A document's share of a set of terms is at most the sum of their largest impacts; where two
neighbours have an intersection list, the larger of the joint maximum and the single maxima takes the
place of their sum, and the least such combination over all pairings bounds the set.

A query scores the documents of its strongest intersection lists first, which gives a threshold: the
k-th best score so far.  Lists are then read whole from the heaviest term on, until the bound
of those left is below the threshold; documents that only occur there cannot be among the k best.  The
remaining lists are looked up for the documents that can still reach the threshold, fewer from list to
list.  Bounds only skip what is strictly below the threshold, so ties are kept, and results
are exact.

Documents: a null or wordless text counts nowhere and is never found.  Each row is a document, so repeated
rows rank side by side; equal scores rank by ascending doc_id, null last.  Rows of one item_id
are one item with the terms of all; items without words, or without matching documents, have no rows.
Texts are read whole at any length.  Other columns are not looked at, and where a table is empty, so is the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.llm.common import discard, stored, texts_as_bytes
from sieveline.llm.decontaminate import words

TOP = 10
#: Distinct terms, summed over items, that a block of items has about; bounds what is sent to tasks.
ITEM_TERMS = 4_000_000
#: A shard is closed at so many postings or documents.
SHARD_POSTINGS, SHARD_DOCUMENTS = 1 << 20, 1 << 16
#: Documents of the strongest intersection lists that are scored to find a threshold.
FIRST_SCORED = 64

_SHARD_DDL = "n_docs long, n_words long, ids array<long>, lengths binary, terms binary, ends binary, docs binary, counts binary"
_INDEX_DDL = (
    "ids array<long>, terms binary, ends binary, docs binary, impacts binary, "
    "pairs binary, joint binary, pair_ends binary, pair_docs binary"
)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Statistics:
    documents: int  # with at least one term
    words: int
    weights: np.ndarray  # by term number


def _bytes(array: np.ndarray, kind: str) -> bytes:
    return np.ascontiguousarray(array, kind).tobytes()


def _numbers(data, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind)


class _Shard:
    """Documents of one task, until their postings become a row."""

    def __init__(self):
        self.n_docs = self.n_words = 0
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.terms: list[int] = []
        self.counts: list[int] = []
        self.sizes: list[int] = []

    def full(self) -> bool:
        return len(self.terms) >= SHARD_POSTINGS or len(self.ids) >= SHARD_DOCUMENTS

    def row(self) -> pa.RecordBatch:
        term = np.array(self.terms, np.int32)
        docs = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        order = np.argsort(term, kind="stable")
        there, starts = np.unique(term[order], return_index=True)
        ends = np.append(starts[1:], len(term)) if len(there) else np.zeros(0)
        binary = [
            _bytes(np.array(self.lengths), "<i8"),
            _bytes(there, "<i4"),
            _bytes(ends, "<i8"),
            _bytes(docs[order], "<i4"),
            _bytes(np.array(self.counts)[order] if len(term) else term, "<i8"),
        ]
        columns = [pa.array([self.n_docs]), pa.array([self.n_words]), pa.array([self.ids], pa.list_(pa.int64()))]
        columns += [pa.array([b], pa.binary()) for b in binary]
        return pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _SHARD_DDL.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    number = vocabulary.value
    shard = _Shard()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)), strict=True):
            own = words(text)
            if not own:
                continue
            shard.n_docs += 1
            shard.n_words += len(own)
            found = [(number[w], c) for w, c in Counter(own).items() if w in number]
            if found:
                shard.ids.append(doc_id)
                shard.lengths.append(len(own))
                shard.sizes.append(len(found))
                shard.terms += [t for t, _ in found]
                shard.counts += [c for _, c in found]
            if shard.full():
                yield shard.row()
                shard = _Shard()
    if shard.n_docs:
        yield shard.row()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Term numbers and how many documents of the shard have them."""
    for batch in batches:
        for terms, ends in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ends = _numbers(ends, "<i8")
            yield pa.RecordBatch.from_arrays(
                [pa.array(_numbers(terms, "<i4")), pa.array(np.diff(ends, prepend=0))], ["term", "df"]
            )


def _statistics(shards: DataFrame, n_terms: int) -> Statistics:
    documents, n_words = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    found = shards.select("terms", "ends").mapInArrow(_frequencies, "term int, df long")
    counted = found.groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # a row for each term of the block at most
    weights = np.zeros(n_terms, np.int64)
    for term, df in zip(counted["term"].to_pylist(), counted["df"].to_pylist(), strict=True):
        weights[term] = weight(documents, df)
    return Statistics(documents, n_words, weights)


def _ordered(terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """An item's terms by falling weight; those without weight add nothing and are left out."""
    terms = terms[np.lexsort((terms, -weights[terms]))]
    return terms[weights[terms] > 0]


def wanted_pairs(items: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """The pairs of terms that follow each other in some item, as first * number of terms + second, sorted."""
    pairs = [np.zeros(0, np.int64)]
    for terms in items:
        own = _ordered(terms, weights).astype(np.int64)
        pairs.append(own[:-1] * len(weights) + own[1:])
    return np.unique(np.concatenate(pairs))


class Lists:
    """Lists one after another, found by a sorted key."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray, *values: np.ndarray):
        self.keys, self.ends, self.values = keys, ends, values

    def find(self, key: int) -> tuple[int, int, int] | None:
        at = int(np.searchsorted(self.keys, key))
        if at == len(self.keys) or self.keys[at] != key:
            return None
        return at, int(self.ends[at - 1]) if at else 0, int(self.ends[at])


def impacts(counts: np.ndarray, lengths: np.ndarray, weights: np.ndarray, statistics: Statistics) -> np.ndarray:
    """What a term adds to a document's score; all in integers."""
    distinct, at = np.unique(lengths, return_inverse=True)
    norm = np.array([10 + (90 * n * statistics.documents) // statistics.words for n in distinct.tolist()], np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * norm[at]))


def _indexed(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Shards with impacts in place of frequencies, and their intersection lists."""
    statistics, pairs = shared.value
    for batch in batches:
        for i in range(batch.num_rows):
            ids, lengths, terms, ends, docs, counts = (batch.column(k)[i] for k in range(6))
            lengths, counts = _numbers(lengths.as_py(), "<i8"), _numbers(counts.as_py(), "<i8")
            terms, docs = _numbers(terms.as_py(), "<i4"), _numbers(docs.as_py(), "<i4")
            bounds = _numbers(ends.as_py(), "<i8")
            each = np.repeat(statistics.weights[terms], np.diff(bounds, prepend=0))
            impact = impacts(counts, lengths[docs], each, statistics)
            lists = Lists(terms, bounds, docs, impact)
            held = np.full(len(lengths), -1, np.int64)
            n, last, kept, joint, both = len(statistics.weights), None, [], [], []
            for pair in pairs.tolist():
                first, second = lists.find(pair // n), lists.find(pair % n)
                if first is None or second is None:
                    continue
                if first != last:
                    if last is not None:
                        held[docs[last[1] : last[2]]] = -1
                    held[docs[first[1] : first[2]]] = impact[first[1] : first[2]]
                    last = first
                here = docs[second[1] : second[2]]
                known = held[here]
                shared_docs = known >= 0
                together = known[shared_docs] + impact[second[1] : second[2]][shared_docs]
                kept.append(pair)
                joint.append(int(together.max(initial=0)))
                both.append(here[shared_docs])
            pair_ends = np.cumsum([len(b) for b in both]) if both else np.zeros(0)
            columns = [pa.array([ids.as_py()], pa.list_(pa.int64()))]
            columns += [
                pa.array([_bytes(a, kind)], pa.binary())
                for a, kind in (
                    (terms, "<i4"), (bounds, "<i8"), (docs, "<i4"), (impact, "<i8"), (np.array(kept), "<i8"), (np.array(joint), "<i8"),
                    (pair_ends, "<i8"), (np.concatenate(both) if both else np.zeros(0), "<i4"),
                )
            ]
            yield pa.RecordBatch.from_arrays(columns, [part.split()[0] for part in _INDEX_DDL.split(", ")])


class ShardIndex:
    """One shard: posting lists with impacts, and intersection lists with joint maxima."""

    def __init__(self, ids, terms, ends, docs, impact, pairs, joint, pair_ends, pair_docs, n_terms: int):
        self.ids, self.n_terms = ids, n_terms
        self.lists = Lists(terms, ends, docs, impact)
        self.pairs = Lists(pairs, pair_ends, pair_docs)
        self.joint = joint
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.most = np.maximum.reduceat(impact, starts) if len(terms) else np.zeros(0, np.int64)
        self.scored = 0  # documents whose lists were read or looked up, for tests

    def bounds(self, terms: list[int], at: list[int]) -> list[int]:
        """For every i, the most that a document can get from terms[i:]; at[i] is the place of the term's list."""
        bound = [0] * (len(terms) + 2)
        for i in range(len(terms) - 1, -1, -1):
            own = int(self.most[at[i]])
            bound[i] = own + bound[i + 1]
            if i + 1 < len(terms) and (pair := self.pairs.find(terms[i] * self.n_terms + terms[i + 1])):
                either = max(int(self.joint[pair[0]]), own, int(self.most[at[i + 1]]))
                bound[i] = min(bound[i], either + bound[i + 2])
        return bound[: len(terms) + 1]

    def _look_up(self, list_: tuple[int, int, int], docs: np.ndarray) -> np.ndarray:
        """What the list adds to each of the documents."""
        own, impact = (v[list_[1] : list_[2]] for v in self.lists.values)
        at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
        return np.where(own[at] == docs, impact[at], 0)

    def _first_threshold(self, terms: list[int], found: list[tuple[int, int, int]], k: int) -> int:
        """The k-th best score among documents of the strongest intersection lists, 0 if they have fewer."""
        there = [p for a, b in zip(terms, terms[1:], strict=False) if (p := self.pairs.find(a * self.n_terms + b))]
        docs = np.zeros(0, np.int32)
        for pair in sorted(there, key=lambda p: -int(self.joint[p[0]])):
            docs = np.union1d(docs, self.pairs.values[0][pair[1] : pair[1] + min(pair[2] - pair[1], FIRST_SCORED)])
            if len(docs) >= FIRST_SCORED:
                break
        if len(docs) < k:
            return 0
        scores = sum(self._look_up(list_, docs) for list_ in found)
        return int(np.partition(scores, -k)[-k])

    def top(self, terms: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the k best for terms in order of falling weight."""
        present = [(int(t), list_) for t in terms if (list_ := self.lists.find(t))]
        if not present:
            return []
        names, found = [t for t, _ in present], [list_ for _, list_ in present]
        bound = self.bounds(names, [list_[0] for list_ in found])
        threshold = self._first_threshold(names, found, k)
        score = np.zeros(len(self.ids), np.int64)
        touched, i = np.zeros(0, np.int64), 0
        while i < len(found) and bound[i] >= max(threshold, 1):
            docs, impact = (v[found[i][1] : found[i][2]] for v in self.lists.values)
            score[docs] += impact
            self.scored += len(docs)
            i += 1
            touched = np.flatnonzero(score)
            if len(touched) >= k:
                threshold = max(threshold, int(np.partition(score[touched], -k)[-k]))
        partial = score[touched]
        for j in range(i, len(found) + 1):
            reach = partial + bound[j] >= threshold
            touched, partial = touched[reach], partial[reach]
            if j < len(found):
                partial = partial + self._look_up(found[j], touched)
                self.scored += len(touched)
                if len(touched) >= k:
                    threshold = max(threshold, int(np.partition(partial, -k)[-k]))
        good = partial > 0
        ranked = sorted(
            zip((-partial[good]).tolist(), touched[good].tolist(), strict=True),
            key=lambda r: (r[0], (ids := self.ids[r[1]]) is None, ids or 0),
        )
        return [(-s, d) for s, d in ranked[:k]]


def _searched(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    items, n_terms = shared.value
    for batch in batches:
        for i in range(batch.num_rows):
            ids, *arrays = (batch.column(c)[i].as_py() for c in range(batch.num_columns))
            kinds = ("<i4", "<i8", "<i4", "<i8", "<i8", "<i8", "<i8", "<i4")
            index = ShardIndex(ids, *[_numbers(a, kind) for a, kind in zip(arrays, kinds, strict=True)], n_terms)
            out = [(item, ids[doc], score) for item, terms in enumerate(items) for score, doc in index.top(terms, k)]
            columns = [pa.array([r[c] for r in out], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = [sorted(set(words(t))) for t in texts_as_bytes(batch.column(1))]
        lists = pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], ["item_id", "terms"])


def item_blocks(items: DataFrame) -> tuple[DataFrame, int]:
    """item_id, terms, block of the items that have terms, stored, and the number of blocks."""
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("terms", T.ArrayType(T.StringType()))])
    cut = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(_item_terms, schema)
    cut = stored(cut.filter(F.size("terms") > 0), "item-terms")
    blocks = math.ceil((cut.agg(F.sum(F.size("terms"))).first()[0] or 0) / ITEM_TERMS)
    return cut.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))), blocks


def build_index(docs: DataFrame, vocabulary: list[bytes], items: list[np.ndarray]) -> tuple[DataFrame, np.ndarray]:
    """The stored index of all documents for these terms, and the terms' weights."""
    context = docs.sparkSession.sparkContext
    numbers = context.broadcast({term: i for i, term in enumerate(vocabulary)})  # ITEM_TERMS bounds it
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = stored(rows.mapInArrow(lambda batches: _shards(batches, numbers), _SHARD_DDL), "shards")
    numbers.destroy()
    statistics = _statistics(shards, len(vocabulary))
    shared = context.broadcast((statistics, wanted_pairs(items, statistics.weights)))
    fields = ["ids", "lengths", "terms", "ends", "docs", "counts"]
    index = stored(shards.select(*fields).mapInArrow(lambda batches: _indexed(batches, shared), _INDEX_DDL), "search-index")
    shared.destroy()
    discard(shards)
    return index, statistics.weights


def _search_block(docs: DataFrame, block: pa.Table, k: int) -> DataFrame:
    """item (its number in block), rank, doc_id, score."""
    lists = [[t.encode() for t in own] for own in block["terms"].to_pylist()]
    vocabulary = sorted({t for own in lists for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    items = [np.array([number[t] for t in own], np.int32) for own in lists]
    index, weights = build_index(docs, vocabulary, items)
    shared = docs.sparkSession.sparkContext.broadcast(([_ordered(own, weights) for own in items], len(vocabulary)))
    found = index.mapInArrow(lambda batches: _searched(batches, shared, k), "item long, doc_id long, score long")
    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(by_rank)).filter(F.col("rank") <= k)
    result = stored(best.select("item", "rank", "doc_id", "score"), "search-block")
    shared.destroy()
    discard(index)
    return result


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark: SparkSession = docs.sparkSession
    schema = T.StructType(
        [
            T.StructField("item_id", items.schema["item_id"].dataType),
            T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )
    cut, blocks = item_blocks(items)
    result = spark.createDataFrame([], schema)
    for number in range(blocks):
        own = cut.filter(F.col("block") == number).groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
        block = own.toArrow()
        found = _search_block(docs, block, k)
        names = spark.createDataFrame(
            pa.table({"item": pa.array(np.arange(block.num_rows)), "item_id": block["item_id"]}),
            T.StructType([T.StructField("item", T.LongType()), schema["item_id"]]),
        )
        result = result.unionByName(found.join(names, "item").select(*schema.names))
    return result

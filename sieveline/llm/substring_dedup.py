"""Removal of long repeated spans by compaction of a De Bruijn graph of word k-mers.

A window is K consecutive words; it is an edge of the graph, from the node of its first K - 1
words to that of its last.  A word goes if a window that covers it also starts in a document with
a smaller doc_id.  In steps:

  1. equal word sequences are one class, whose smallest doc_id stands for it; rows of the class
     with larger ids repeat all their windows;
  2. every window has a minimizer, the least hash of its SEED-word grams, so windows that occur
     twice share one; only documents with minimizers that several classes have go on;
  3. their windows become edges; an edge's source is its first occurrence, and edges with
     occurrences in several documents are the repeated ones;
  4. joins with the degrees of their nodes find where the graph branches, and repeated edges that
     follow each other in the source without a branch are compacted to paths;
  5. occurrences of paths are spans with source coordinates, and a span counts only if its words
     have the same SHA-256 as the words at its source.

Windows are judged on the input.  Null texts have no words.  A row without doc_id is left whole
and is nobody's source; rows that repeat id and text fare alike.  Other columns are not looked
at, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import release, slices, stored, texts_as_bytes
from sieveline.llm.shingles import ngram_hashes, word_hashes

#: Words of a window, and of the grams that minimizers are taken from.
K, SEED = 50, 15
_NOTHING = hashlib.sha256(b"").hexdigest()

DOC_DDL = "doc_id long, n_words long, words_sha256 string, minimizers array<long>"
EDGE_DDL = "doc long, c long, text binary, starts array<int>, edges array<long>, nodes array<long>"


def sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def hashed(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and their hashes, text by text."""
    for a, b in slices(texts):
        words = [(t or b"").split() for t in texts[a:b]]
        hashes, counts = word_hashes(words, salt=3)
        ends = np.cumsum(counts)
        for w, start, end in zip(words, (ends - counts).tolist(), ends.tolist()):
            yield w, hashes[start:end]


def window_minimizers(hashes: np.ndarray) -> np.ndarray:
    """The minimizer of every window."""
    least = ngram_hashes(hashes, SEED)
    wide, left = 1, K - SEED + 1
    if len(least) < left:
        return np.zeros(0, np.uint64)
    while 2 * wide <= left:
        least, wide = np.minimum(least[:-wide], least[wide:]), 2 * wide
    rest = left - wide
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, shas, seeds = [], [], []
        for words, hashes in hashed(texts_as_bytes(batch.column(1))):
            counts.append(len(words))
            shas.append(sha(words))
            seeds.append(np.unique(window_minimizers(hashes)).astype(np.int64))
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(seeds, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "words_sha256", "minimizers"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, c, SHA-256, shared minimizers, text): the windows that have one, as edges between nodes."""
    for batch in batches:
        doc, c, own, shared = (batch.column(i).to_pylist() for i in range(4))
        rows = []
        for i, (words, hashes) in enumerate(hashed(texts_as_bytes(batch.column(4)))):
            if sha(words) != own[i]:  # another text of the same id
                continue
            seeds = np.sort(np.array(shared[i], np.int64).astype(np.uint64))
            least = window_minimizers(hashes)
            at = np.minimum(np.searchsorted(seeds, least), len(seeds) - 1)
            starts = np.flatnonzero(seeds[at] == least)
            edges, nodes = ngram_hashes(hashes, K), ngram_hashes(hashes, K - 1)
            ends = np.stack([nodes[starts], nodes[starts + 1]], axis=1).ravel()
            rows.append((doc[i], c[i], b" ".join(words), starts.astype(np.int32), edges[starts].astype(np.int64), ends.astype(np.int64)))
        if rows:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "c", "text", "starts", "edges", "nodes"])


def class_key() -> Column:
    """A short name for a word sequence, among those of one doc_id."""
    return F.xxhash64("words_sha256")


def documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, words_sha256 and the minimizers of its windows; stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(_documents, DOC_DDL), "documents")


def candidate_edges(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per class that shares minimizers with others: its edges; stored."""
    classes = known.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= K))
    first = classes.groupBy("words_sha256").agg(F.min("doc_id").alias("doc"), F.first("minimizers").alias("minimizers"))
    seeds = stored(first.select("doc", "words_sha256", F.explode("minimizers").alias("seed")), "seeds")
    several = seeds.groupBy("seed").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("seed")
    wanted = seeds.join(several, "seed").groupBy("doc", "words_sha256").agg(F.collect_list("seed").alias("shared"))  # a document's own
    wanted = stored(wanted.withColumn("c", class_key()), "wanted")
    release(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    found = rows.join(wanted, "doc").select("doc", "c", "words_sha256", "shared", "text").mapInArrow(_edges, EDGE_DDL)
    return stored(found, "edges")


def occurrences(edges: DataFrame) -> DataFrame:
    """edge, doc, c, pos, left, right of every candidate window."""
    at = F.posexplode("edges").alias("i", "edge")
    each = edges.select("doc", "c", "starts", "nodes", at)
    return each.select(
        "edge", "doc", "c", F.get("starts", F.col("i")).alias("pos"), F.get("nodes", 2 * F.col("i")).alias("left"), F.get("nodes", 2 * F.col("i") + 1).alias("right")
    )


def repeated_edges(each: DataFrame) -> DataFrame:
    """edge, doc, c, pos (of its first occurrence), left, right of the edges that occur in several documents; stored."""
    source = F.min(F.struct("doc", "c", "pos", "left", "right")).alias("src")
    found = each.groupBy("edge").agg(source, F.max("doc").alias("last")).filter(F.col("src.doc") < F.col("last"))
    return stored(found.select("edge", "src.*"), "repeated")


def compact(ends: DataFrame) -> DataFrame:
    """edge, and the path it lies on: src_doc, src_c, path (position of the path's first edge in the source), offset.

    A path goes on where the next edge in the source is repeated too and their common node has no
    other repeated edge in or out.
    """
    into = ends.groupBy(F.col("right").alias("node")).agg(F.count("*").alias("n_in"))
    out = ends.groupBy(F.col("left").alias("node")).agg(F.count("*").alias("n_out"))
    plain = into.join(out, "node").filter("n_in = 1 AND n_out = 1").select(F.col("node").alias("left"), F.lit(True).alias("inner"))
    marked = ends.join(plain, "left", "left")
    order = Window.partitionBy("doc", "c").orderBy("pos")  # a source document's own edges
    goes_on = F.coalesce(F.col("inner") & (F.lag("pos").over(order) == F.col("pos") - 1), F.lit(False))
    heads = marked.withColumn("head", F.when(~goes_on, F.col("pos")))
    path = F.last("head", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    on = heads.withColumn("path", path)
    return on.select("edge", F.col("doc").alias("src_doc"), F.col("c").alias("src_c"), "path", (F.col("pos") - F.col("path")).alias("offset"))


def spans(each: DataFrame, paths: DataFrame) -> DataFrame:
    """Stretches of windows of a document, none missing in between, that follow one path whose source is a
    smaller document: doc, c, start, n_words, src_doc, src_c, src_start; stored."""
    hits = each.select("edge", "doc", "c", "pos").join(paths, "edge").filter(F.col("src_doc") < F.col("doc"))
    line = F.col("pos") - F.col("offset")  # the same along a path
    keys = ["doc", "c", "src_doc", "src_c", "path", "line"]
    hits = hits.select("doc", "c", "pos", "src_doc", "src_c", "path", line.alias("line"))
    # a copy may leave the path and come back on the same line, as where a word was replaced
    stretch = F.col("pos") - F.row_number().over(Window.partitionBy(*keys).orderBy("pos"))  # a document's own windows
    cut = hits.withColumn("stretch", stretch).groupBy(*keys, "stretch").agg(F.min("pos").alias("start"), F.max("pos").alias("last"))
    src_start = F.col("path") + F.col("start") - F.col("line")
    found = cut.select("doc", "c", "start", (F.col("last") - F.col("start") + K).alias("n_words"), "src_doc", "src_c", src_start.alias("src_start"))
    return stored(found, "spans")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, asked spans): the SHA-256 of each span's words."""
    for batch in batches:
        found = []
        for text, asked in zip(texts_as_bytes(batch.column(2)), batch.column(3).to_pylist()):
            words = text.split(b" ")
            found.append([sha(words[s["start"] : s["start"] + s["n_words"]]) for s in asked])
        columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(found, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "c", "asked", "digests"])


def verified(found: DataFrame, edges: DataFrame) -> DataFrame:
    """The spans whose words equal those at their source; stored."""
    mine = found.select("doc", "c", F.struct("start", "n_words").alias("s"))
    source = found.select(F.col("src_doc").alias("doc"), F.col("src_c").alias("c"), F.struct(F.col("src_start").alias("start"), "n_words").alias("s"))
    asked = mine.unionByName(source).groupBy("doc", "c").agg(F.collect_set("s").alias("asked"))  # a document's own stretches
    texts = edges.select("doc", "c", "text").dropDuplicates(["doc", "c"])
    ddl = "doc long, c long, asked array<struct<start: int, n_words: int>>, digests array<string>"
    digests = texts.join(asked, ["doc", "c"]).mapInArrow(_digests, ddl)
    digests = digests.select("doc", "c", F.inline(F.arrays_zip("asked", "digests"))).select("doc", "c", "asked.*", "digests")
    digests = stored(digests, "digests")
    own = digests.withColumnRenamed("digests", "own")
    theirs = digests.toDF("src_doc", "src_c", "src_start", "n_words", "theirs")
    both = found.join(own, ["doc", "c", "start", "n_words"]).join(theirs, ["src_doc", "src_c", "src_start", "n_words"])
    return stored(both.filter("own = theirs").select("doc", "c", "start", "n_words"), "verified")


def parts(found: DataFrame, good: DataFrame) -> DataFrame | None:
    """The windows of the spans that failed, each as a span of its own; None where none failed."""
    failed = found.join(good, ["doc", "c", "start"], "left_anti")
    if failed.isEmpty():
        return None
    each = failed.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_words") - K)))
    at = [(F.col(name) + F.col("i")).alias(name) for name in ("start", "src_start")]
    return stored(each.select("doc", "c", at[0], F.lit(K).alias("n_words"), "src_doc", "src_c", at[1]), "parts")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, c, text, spans): what is left of the text."""
    for batch in batches:
        removed, shas, kept = [], [], []
        for text, own in zip(texts_as_bytes(batch.column(2)), batch.column(3).to_pylist()):
            words = text.split(b" ")
            gone = np.zeros(len(words), bool)
            for s in own:
                gone[s["start"] : s["start"] + s["n_words"]] = True
            rest = [w for w, g in zip(words, gone.tolist()) if not g]
            removed.append(int(gone.sum()))
            kept.append(b" ".join(rest).decode("utf-8", "replace"))
            shas.append(sha(rest))
        columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(shas), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "c", "n_removed", "kept_sha256", "kept_text"])


def removals(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per class that loses words: c, doc, n_removed, kept_sha256, kept_text; stored."""
    edges = candidate_edges(docs, known)
    each = occurrences(edges)
    repeated = repeated_edges(each)
    release(docs.sparkSession)
    found = spans(each, stored(compact(repeated), "paths"))
    release(docs.sparkSession)
    good = verified(found, edges)
    if (single := parts(found, good)) is not None:
        good = good.unionByName(verified(single, edges))
    release(docs.sparkSession)
    own = good.groupBy("doc", "c").agg(F.collect_set(F.struct("start", "n_words")).alias("spans"))  # a document's own stretches
    texts = edges.select("doc", "c", "text").dropDuplicates(["doc", "c"])
    ddl = "doc long, c long, n_removed long, kept_sha256 string, kept_text string"
    return stored(texts.join(own, ["doc", "c"]).mapInArrow(_without, ddl), "removals")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256, kept_text (null where nothing is removed)."""
    known = documents(docs)
    lost = removals(docs, known)
    first = known.filter("doc_id IS NOT NULL").groupBy("words_sha256").agg(F.min("doc_id").alias("doc"), F.count("*").alias("n"))
    first = first.withColumn("c", class_key()).join(lost, ["doc", "c"], "left").filter("n > 1 OR n_removed IS NOT NULL")
    joined = known.join(first.drop("n", "c"), "words_sha256", "left")
    copy = F.coalesce((F.col("doc_id") > F.col("doc")) & (F.col("n_words") >= K), F.lit(False))
    cut = F.col("doc_id").isNotNull() & F.col("n_removed").isNotNull()
    return joined.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).when(cut, F.col("n_removed")).otherwise(0).alias("n_removed"),
        F.when(copy, _NOTHING).when(cut, F.col("kept_sha256")).otherwise(F.col("words_sha256")).alias("kept_sha256"),
        F.when(copy, "").when(cut, F.col("kept_text")).alias("kept_text"),
    )

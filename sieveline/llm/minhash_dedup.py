"""Near-duplicate detection by b-bit MinHash.

A document is the set of its distinct three-word shingles, and equal sets are one vertex.  HASHES
minima per set are taken, each the least value of its shingles under one hash function.  The first
BANDS * BAND_ROWS of them form bands, whose hashes are bucket keys; of all of them the lowest BITS bits are kept and
packed into a signature of 128 bytes.  Two vertices that share a bucket are candidates.  Their
signatures agree in more places than their minima do, since low bits also agree by chance, in
2^-BITS of all cases; with that share taken off, the count of equal places estimates their
similarity.  Candidates whose estimate is more than five standard deviations below the threshold are dropped, and all
others are compared on their full sets.  A pair at the threshold shares no bucket with odds of 4e-8
and falls to the estimate with odds of 3e-7; more similar pairs with far lower ones.

Only components are asked for, so what is already joined is not compared again:
  1. in LEADER_ROUNDS rounds, every vertex is compared with a leader of each of the buckets it shares
     most keys with, and each confirmed link joins components;
  2. in buckets that still hold several components, members of different ones are compared.  A large bucket is
     cut into chunks, and pairs of chunks are separate pieces of work.  Estimates come first, on signatures alone;
     texts are then sent to a piece for members that may link there.  A pair is taken from the first band that it
     shares, and no list of pairs leaves a piece.
Leaders and their followers meet in cells of bounded size, so that a leader's text is sent once per cell.
Cells and pieces report links that join what links in them, not all of them.

Texts that are null or without words have an empty set and are linked with nothing; a shorter text than three
words is one shingle.  A row without doc_id takes part like any other and names no component; rows of
equal sets share their component.  kept marks the rows whose doc_id names their component (where no row of a
component has an id, all of them).  Texts are read whole at any length; other columns are not looked at, and an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import discard, slices, stored, texts_as_bytes
from sieveline.llm.components import components
from sieveline.llm.shingles import mix, shingle_sets

N = 3
#: A link needs DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 85, 100
#: Minima per set, bits kept of each, and how many of them make bands of how many.
HASHES, BITS, BANDS, BAND_ROWS = 512, 2, 36, 6
#: Estimates below this are dropped: five standard deviations of an estimate at the threshold.
LEAST_ESTIMATE = 0.757
LEADER_ROUNDS, LEADERS = 2, 2
#: Members of a bucket's chunk; texts of a cell; shingles of either.
BUCKET_CHUNK, CELL_TEXTS, CELL_SHINGLES = 512, 128, 1 << 20

_FACTORS = (mix(np.arange(1, HASHES + 1, dtype=np.uint64), 13) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SKETCH = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("v", T.BinaryType()),
        T.StructField("signature", T.BinaryType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ]
)


def sets_of(texts: list[bytes | None]) -> Iterator[list[np.ndarray]]:
    """The shingle sets of the texts, slice by slice."""
    for a, b in slices(texts):
        yield shingle_sets([(t or b"").lower().split() for t in texts[a:b]], N)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """A row of minima per set; sets must not be empty."""
    out = np.empty((HASHES, len(sets)), np.uint32)
    if not sets:
        return out.T
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    hashed = np.empty_like(values)
    for i, factor in enumerate(_FACTORS):
        np.multiply(values, factor, out=hashed)
        np.minimum.reduceat(hashed, starts, out=out[i])
    return out.T


def band_keys(low: np.ndarray) -> np.ndarray:
    """A key per row and band; the band is part of it."""
    rows = low[:, : BANDS * BAND_ROWS].reshape(len(low), BANDS, BAND_ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(BAND_ROWS):
        keys = mix(keys ^ rows[:, :, i], 17 + i)
    return keys.astype(np.int64)


def signatures(low: np.ndarray) -> np.ndarray:
    """The BITS low bits of (scrambled) minima, packed: a row of bytes per set, plane after plane."""
    scrambled = mix(low.astype(np.uint64), 5)
    planes = [np.packbits((scrambled >> np.uint64(b) & np.uint64(1)).astype(np.uint8), axis=1) for b in range(BITS)]
    return np.ascontiguousarray(np.concatenate(planes, axis=1))


def estimates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of packed signatures, row by row (shapes are broadcast)."""
    words = HASHES // 64
    x, y = x.view(np.uint64), y.view(np.uint64)
    unlike = reduce(np.bitwise_or, [x[..., k * words : (k + 1) * words] ^ y[..., k * words : (k + 1) * words] for k in range(BITS)])
    agree = 1 - np.bitwise_count(unlike).sum(axis=-1, dtype=np.int64) / HASHES
    chance = 2.0**-BITS
    return (agree - chance) / (1 - chance)


def set_name(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)


@arrow_udf(_SKETCH)
def sketch(text: pa.Array) -> pa.Array:
    sizes, names, packed, keys = [], [], [], []
    for sets in sets_of(texts_as_bytes(text)):
        low = minima([s for s in sets if len(s)])
        rows, own = iter(signatures(low)), iter(band_keys(low).tolist())
        for s in sets:
            sizes.append(len(s))
            names.append(set_name(s))
            packed.append(next(rows).tobytes() if len(s) else None)
            keys.append(next(own) if len(s) else None)
    columns = [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(packed, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
    return pa.StructArray.from_arrays(columns, _SKETCH.names)


@arrow_udf(T.BinaryType())
def vertex_name(text: pa.Array) -> pa.Array:
    return pa.array([set_name(s) for sets in sets_of(texts_as_bytes(text)) for s in sets], pa.binary())


def sizes_agree(n: Column, m: Column) -> Column:
    return (DENOMINATOR * n >= NUMERATOR * m) & (DENOMINATOR * m >= NUMERATOR * n)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n, v, signature, keys of every row, stored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), sketch(F.col("text").cast("string")).alias("s"))
    return stored(rows.select("doc_id", "s.*"), "sketches")


def vertices(named: DataFrame) -> DataFrame:
    """id (a number of its own), v, n, doc_id (the least), signature, keys of the distinct sets, stored."""
    firsts = [F.first(c).alias(c) for c in ("n", "signature", "keys")]
    distinct = named.filter("n > 0").groupBy("v").agg(F.min("doc_id").alias("doc_id"), *firsts)
    return stored(distinct.withColumn("id", F.monotonically_increasing_id()), "vertices")


def buckets(found: DataFrame) -> DataFrame:
    """key, id, n of the vertices in buckets of several vertices, stored."""
    rows = found.select(F.explode("keys").alias("key"), "id", "n")
    shared = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("key")
    return stored(rows.join(shared.hint("merge"), "key"), "buckets")


def vertex_texts(docs: DataFrame, found: DataFrame, members: DataFrame) -> DataFrame:
    """id, n, signature, keys, text of the vertices in members, stored."""
    asked = members.groupBy("id").agg(F.lit(1).alias("one")).select("id")
    wanted = stored(found.join(asked, "id", "left_semi").select("id", "v", "n", "doc_id", "signature", "keys"), "wanted")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    some = rows.join(wanted.select("doc_id").filter("doc_id IS NOT NULL").hint("merge"), "doc_id", "left_semi")
    if not wanted.filter("doc_id IS NULL").isEmpty():
        some = some.unionByName(rows.filter("doc_id IS NULL"))
    some = stored(some.select("text"), "wanted-texts")
    # ids may repeat, so a text counts only for the vertex that its own set names
    own = some.select(vertex_name("text").alias("v"), "text")
    once = own.join(wanted.drop("doc_id"), "v").groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "signature", "keys", "text")])
    result = stored(once, "vertex-texts")
    discard(wanted, some)
    return result


# ---- confirming candidates on full sets, cell by cell


def joining_links(
    x: np.ndarray, y: np.ndarray, near: np.ndarray, component: list[int], text: Callable[[int], bytes]
) -> list[tuple[int, int]]:
    """Of the candidate pairs (x, y) of rows, links that join all that link, the most similar first.

    component[row] is the component known so far; pairs that are joined already are not compared.
    """
    root = list(range(max(component, default=-1) + 1))
    sets: dict[int, np.ndarray] = {}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def tokens(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = shingle_sets([text(row).lower().split()], N)[0]
        return sets[row]

    found = []
    for i in np.argsort(-near, kind="stable").tolist():
        if near[i] < LEAST_ESTIMATE:
            break
        a, b = int(x[i]), int(y[i])
        if (p := find(component[a])) != (q := find(component[b])) and linked(tokens(a), tokens(b)):
            root[p] = q
            found.append((a, b))
    return found


class _Cell:
    """The texts of a cell and the candidates among them."""

    def __init__(self):
        self.at: dict[int, int] = {}
        self.texts: list[bytes] = []
        self.packed: list[bytes] = []
        self.pairs: list[tuple[int, int]] = []

    def links(self) -> list[tuple[int, int]]:
        if not self.pairs:
            return []
        ids = list(self.at)
        x, y = (np.array([self.at[p[k]] for p in self.pairs]) for k in (0, 1))
        packed = np.frombuffer(b"".join(self.packed), np.uint8).reshape(len(ids), -1)
        near = estimates(packed[x], packed[y])
        links = joining_links(x, y, near, list(range(len(ids))), self.texts.__getitem__)
        return [(ids[a], ids[b]) for a, b in links]


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, kind: texts (kind 0: id in a), then pairs (kind 1: a, b).  Pairs that link."""
    number, cell = None, _Cell()

    def told(links: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        numbers, kinds, a, b, packed = (batch.column(k).to_pylist() for k in range(5))
        texts = texts_as_bytes(batch.column(5))
        for i in range(batch.num_rows):
            if numbers[i] != number:
                yield told(cell.links())
                number, cell = numbers[i], _Cell()
            if kinds[i] == 0:
                cell.at[a[i]] = len(cell.texts)
                cell.texts.append(texts[i])
                cell.packed.append(packed[i])
            else:
                cell.pairs.append((a[i], b[i]))
    yield told(cell.links())


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b, cell) whose full sets link, stored; pairs must be stored."""
    ends = pairs.select("cell", F.col("a").alias("id")).union(pairs.select("cell", F.col("b").alias("id")))
    once = ends.groupBy("cell", "id").agg(F.lit(1).alias("one")).select("cell", "id")
    none = F.lit(None)
    sent = once.join(texts.drop("keys"), "id").select(
        "cell", F.lit(0).alias("kind"), F.col("id").alias("a"), none.cast("long").alias("b"), "signature", "text"
    )
    asked = pairs.select("cell", F.lit(1).alias("kind"), "a", "b", none.cast("binary").alias("signature"), none.cast("string").alias("text"))
    dealt = sent.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "kind")
    return stored(dealt.mapInArrow(_confirmed, "a long, b long"), "links")


def _chunks(members: Column, shingles: Column) -> Column:
    return F.ceil(F.greatest(members / CELL_TEXTS, shingles / CELL_SHINGLES))


def leader_pairs(labelled: DataFrame, round_: int) -> DataFrame:
    """a, b, cell: each vertex with leaders, in other components, of the buckets they share most of."""
    draw = F.xxhash64(F.lit(round_), "id")
    leader = F.min(F.struct(draw.alias("draw"), "id", "n", "g")).alias("leader")
    leaders = labelled.groupBy("key").agg(leader, F.min("g").alias("lo"), F.max("g").alias("hi")).filter("lo < hi")
    met = labelled.join(leaders, "key").filter((F.col("g") != F.col("leader.g")) & sizes_agree(F.col("n"), F.col("leader.n")))
    shared = met.groupBy(F.col("id").alias("a"), F.col("leader.id").alias("b")).agg(F.count(F.lit(1)).alias("count"), F.first("n").alias("n"))
    best = F.slice(F.sort_array(F.collect_list(F.struct("count", "b", "n")), False), 1, LEADERS)  # BANDS at most
    chosen = stored(shared.groupBy("a").agg(best.alias("best")).select("a", F.explode("best").alias("m")).select("a", "m.b", "m.n"), "leader-pairs")
    sizes = chosen.groupBy("b").agg(_chunks(F.count(F.lit(1)), F.sum("n")).alias("k"))
    cell = F.xxhash64("b", F.pmod(F.xxhash64("a"), "k"))
    result = stored(chosen.join(sizes, "b").select("a", "b", cell.alias("cell")), "leader-cells")
    discard(chosen)
    return result


# ---- what is left: buckets of several components, chunk by chunk

_MEMBER_DDL = "key long, i long, j long, chunk long, id long, g long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key, i, j, cut where these change."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        before = held[-1].slice(held[-1].num_rows - 1) if held else table.slice(0, 1)
        marks = [np.concatenate([before[c].to_numpy(), table[c].to_numpy()]) for c in ("key", "i", "j")]
        cuts = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])).tolist()
        fresh = set(cuts)
        for start, end in zip([0, *cuts], [*cuts, table.num_rows], strict=True):
            if held and start in fresh:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            if end > start:
                held.append(table.slice(start, end - start))
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _candidates(piece: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows between chunks i and j of different components whose estimate allows a link, and the estimates.

    Pairs that share an earlier band's bucket as well are left to that one.
    """
    chunk, groups, n = (piece[c].to_numpy() for c in ("chunk", "g", "n"))
    key, i, j = piece["key"][0].as_py(), piece["i"][0].as_py(), piece["j"][0].as_py()
    packed = np.frombuffer(b"".join(piece["signature"].to_pylist()), np.uint8).reshape(len(n), -1)
    keys = piece["keys"].combine_chunks().flatten().to_numpy().reshape(len(n), BANDS)
    band = int(np.flatnonzero(keys[0] == key)[0])
    left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    found = [np.zeros((3, 0))]
    for x in left.tolist():
        others = right[right > x] if i == j else right
        close = (groups[others] != groups[x]) & (DENOMINATOR * n[others] >= NUMERATOR * n[x]) & (DENOMINATOR * n[x] >= NUMERATOR * n[others])
        others = others[close]
        near = estimates(packed[x], packed[others])
        others, near = others[near >= LEAST_ESTIMATE], near[near >= LEAST_ESTIMATE]
        own = ~(keys[others, :band] == keys[x, :band]).any(axis=1)
        found.append(np.stack([np.full(own.sum(), x), others[own], near[own]]))
    x, y, near = np.concatenate(found, axis=1)
    return x.astype(np.int64), y.astype(np.int64), near


def _near_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each piece that are part of a candidate pair; no texts are needed for that."""
    names = [part.split()[0] for part in _MEMBER_DDL.split(", ")]
    for piece in _pieces(batches):
        x, y, _ = _candidates(piece)
        if len(x):
            yield piece.select(names).take(pa.array(np.union1d(x, y))).combine_chunks().to_batches()[0]


def _piece_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join the components of each piece as all its candidates that link would."""
    for piece in _pieces(batches):
        x, y, near = _candidates(piece)
        ids, texts = piece["id"].to_pylist(), piece["text"].combine_chunks().cast(pa.binary())
        _, component = np.unique(piece["g"].to_numpy(), return_inverse=True)
        links = joining_links(x, y, near, component.tolist(), lambda row: texts[row].as_py())
        columns = [pa.array([ids[link[k]] for link in links], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def bucket_links(labelled: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b), stored, that join what links among different components in shared buckets."""
    members, shingles = F.count(F.lit(1)), F.sum("n")
    chunks = F.ceil(F.greatest(members / BUCKET_CHUNK, shingles / CELL_SHINGLES)).alias("k")
    mixed = labelled.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), chunks).filter("lo < hi")
    rows = labelled.join(mixed.select("key", "k"), "key")
    chunk = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), "k")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    pieces = chunk.select("key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "id", "g", "n")

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    signed = pieces.join(found.select("id", "signature", "keys"), "id")
    near = stored(dealt(signed).mapInArrow(_near_members, _MEMBER_DDL), "near-members")
    result = stored(dealt(near.join(texts, "id")).mapInArrow(_piece_links, "a long, b long"), "links")
    discard(near)
    return result


def vertex_components(docs: DataFrame, found: DataFrame) -> DataFrame | None:
    """v (as id), c of every vertex that has a link (None: there are none)."""
    members = buckets(found)
    texts = vertex_texts(docs, found, members)
    edges = groups = None

    def labels() -> DataFrame:
        if groups is None:
            return members.withColumn("g", F.col("id"))
        named = groups.select(F.col("v").alias("id"), "c")
        return members.join(named, "id", "left").withColumn("g", F.coalesce("c", "id")).drop("c")

    for step in range(LEADER_ROUNDS + 1):
        labelled = stored(labels(), "labelled")
        if step < LEADER_ROUNDS:
            pairs = leader_pairs(labelled, step)
            new = confirm(pairs, texts)
            discard(pairs)
        else:
            new = bucket_links(labelled, found, texts)
        discard(labelled)
        if new.isEmpty():
            continue
        edges = new if edges is None else edges.unionByName(new)
        discard(groups)
        groups = components(edges)
    discard(members, texts)
    return groups


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id, kept."""
    named = sketches(docs)
    found = vertices(named)
    groups = vertex_components(docs, found)
    whole = found.select("v", "id", "doc_id")
    if groups is None:
        classes = whole.select("v", F.col("doc_id").alias("component_id"))
    else:
        labelled = whole.join(groups.select(F.col("v").alias("id"), "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
        least = labelled.groupBy("c").agg(F.min("doc_id").alias("component_id"))
        classes = labelled.join(least, "c").select("v", "component_id")
    rows = named.select("doc_id", "n", "v").join(classes, "v", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )

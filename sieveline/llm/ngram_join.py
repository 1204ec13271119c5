"""N-gram Jaccard self-join by a token-group matrix.

A document is the set of its distinct five-word shingles, held as 64-bit hashes; equal sets are
one vertex, told apart by a 128-bit hash of the set.  Two vertices link when their Jaccard similarity
is at least THRESHOLD, which is checked on the complete sets.

A set lists its first tokens in one fixed order, as many as a link cannot all avoid.  The order puts tokens
last that many sets would list if all were ordered by hash; it decides how many groups are opened, never
which links are found.  Only listed tokens that several vertices share go on.

  1. In LEADER_ROUNDS rounds, every vertex joins the leader with which it shares most listed tokens.  A leader
     and its followers are a group, which is opened: what links in it becomes one component.
  2. Vertices of tokens that several components still list are dealt into groups: large components in groups of their
     own, small ones beside others with the same leader, all cut by size of set and into chunks of bounded size.  The
     matrix has a row for each token and group: that some member lists it, the range of sizes of these members, and how
     many of their tokens may follow.  Two groups are opened to each other, or a group to itself, when the
     tokens that both list, summed, and what may lie beyond the lists can reach the threshold.
  3. Open groups meet in one task: a group with all smaller ones that are opened to it, which are dealt into parts of
     bounded size.  There the union of all tokens of one side bounds the overlap of each member of the other one, and
     only members whose bound reaches the threshold are compared; overlaps of all of them come from products of the
     members' token matrices.

Every link has a listed token that both ends share, and so a pair of groups that is opened: nothing is found
outside the groups.  Members of one component are not compared again, and groups report links that join what links in
them, not all of them.

Texts that are null or without words are linked with nothing and have an empty set.  A row
without doc_id takes part like any other and names no component; rows of equal sets share their
component.  Texts are read whole at any length.  Other columns are not looked at, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import discard, fresh_name, release, slices, stored, texts_as_bytes
from sieveline.llm.components import components
from sieveline.llm.shingles import shingle_sets

N = 5
#: A link needs DENOMINATOR * intersection >= NUMERATOR * union.
NUMERATOR, DENOMINATOR = 75, 100
#: A token that more sets list than this comes last in the order, the most frequent at the end; so many tokens are told apart.
OFTEN, ORDER_TOKENS = 8, 1_000_000
#: Rounds of groups around leaders; one token in so many helps to choose a leader.
LEADER_ROUNDS, LEADER_TOKENS = 2, 4
#: Members and tokens of a group.
GROUP_MEMBERS, GROUP_TOKENS = 256, 1 << 20
#: A token that more groups list than this is not summed for every pair of them.
COMMON = 64
#: Parts of a size step, by which cells of such tokens meet.
STEP_PARTS = 8
#: Columns of the token matrices multiplied at once; names that a task remembers to list a set once.
COLUMNS, REMEMBERED = 4096, 100_000
#: Bits of the numbers that stand for vertices; where two sets get one number, both get others.
NUMBER_BITS = 64

_LONG = np.int64
_VERTEX = T.StructType([T.StructField("n", T.LongType()), T.StructField("v", T.BinaryType())])


def sets_of(texts: list[bytes | None], n: int = N) -> Iterator[np.ndarray]:
    """The shingle set of every text."""
    for a, b in slices(texts):
        yield from shingle_sets([(t or b"").lower().split() for t in texts[a:b]], n)


def set_name(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def prefix_size(n: int) -> int:
    """How many first tokens of a set of n tokens a link cannot all avoid."""
    return n - math.ceil(n * NUMERATOR / DENOMINATOR) + 1


# ---- vertices and the tokens they list

_NAMED_DDL = "doc_id long, n_shingles long, v binary, first array<long>"


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, names, first = [], [], []
        for own in sets_of(texts_as_bytes(batch.column(1))):
            sizes.append(len(own))
            names.append(set_name(own))
            first.append(own[: prefix_size(len(own)) if len(own) else 0].astype(_LONG))  # hashes, so their own order will do
        offsets = pa.array(np.cumsum([0] + [len(f) for f in first]), pa.int32())
        tokens = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, _LONG), *first])))
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), tokens]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "v", "first"])


def vertices(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, v, first (the first tokens by hash) of every row, stored."""
    return stored(_rows(docs).mapInArrow(_named, _NAMED_DDL), "vertices")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _number(v: Column, second: bool) -> Column:
    half = F.conv(F.hex(F.substring(v, 9 if second else 1, 8)), 16, -10).cast("long")
    return half if second else F.shiftright(half, 64 - NUMBER_BITS)


def numbered(named: DataFrame) -> tuple[DataFrame, list[bytes]]:
    """v, n, doc_id (the least), id of the distinct sets that are not empty, stored; and the names whose first
    half is no number of their own (some N * N / 2^65 of N)."""
    distinct = named.filter("n_shingles > 0").groupBy("v").agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"))
    found = stored(distinct.withColumn("id", _number(F.col("v"), False)), "numbered")

    def clashes(rows: DataFrame) -> DataFrame:
        return rows.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("id")

    renamed = [bytes(r.v) for r in found.join(clashes(found), "id", "left_semi").select("v").collect()]
    if renamed:
        table = named.sparkSession.createDataFrame([(v,) for v in renamed], "v binary").withColumn("again", F.lit(True))
        number = F.when(F.col("again"), _number(F.col("v"), True)).otherwise(F.col("id"))
        old, found = found, stored(found.join(table, "v", "left").select("v", "n", "doc_id", number.alias("id")), "numbered")
        discard(old)
        if not clashes(found).isEmpty():
            raise RuntimeError("two sets still share a number; run again with another hash")
    return found, renamed


def number_of(name: bytes, renamed: set[bytes], bits: int) -> int:
    if name in renamed:
        return int.from_bytes(name[8:], "big", signed=True)
    return int.from_bytes(name[:8], "big", signed=True) >> (64 - bits)


def token_order(named: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many sets list when all are ordered by hash, sorted, and how many do."""
    counted = named.select(F.explode("first").alias("token")).groupBy("token").count().filter(F.col("count") > OFTEN)
    top = counted.orderBy(F.desc("count"), "token").limit(ORDER_TOKENS).toArrow()
    tokens, counts = top["token"].to_numpy().astype(np.uint64), top["count"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], counts[order]


_LISTED_DDL = "token long, id long, n int, rest int"


def _first_tokens(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """Rows (token, id, n, rest): the first tokens of each set; rest counts the token and all behind it."""
    often, counts, renamed, bits = known.value
    seen: set[bytes] = set()
    for batch in batches:
        tokens, ids, sizes, rests = [], [], [], []
        for own in sets_of(texts_as_bytes(batch.column(0))):
            if not len(own) or (name := set_name(own)) in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(name)
            k, first = prefix_size(len(own)), own
            if len(often):
                at = np.minimum(np.searchsorted(often, own), len(often) - 1)
                often_listed = often[at] == own
                first = own[~often_listed]
                if len(first) < k:
                    last = own[often_listed]
                    first = np.concatenate([first, last[np.argsort(counts[at[often_listed]], kind="stable")]])
            first = first[:k]
            tokens.append(first.astype(_LONG))
            ids.append(np.full(k, number_of(name, renamed, bits), _LONG))
            sizes.append(np.full(k, len(own), np.int32))
            rests.append(np.arange(len(own), len(own) - k, -1, dtype=np.int32))
        if tokens:
            columns = [pa.array(np.concatenate(c)) for c in (tokens, ids, sizes, rests)]
            yield pa.RecordBatch.from_arrays(columns, ["token", "id", "n", "rest"])


def _shared_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by token: those of tokens that several vertices list, each once in a batch."""
    held, given = None, False  # the last row so far, and whether it was let through
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        order = np.lexsort((table.column(1).to_numpy(), table.column(0).to_numpy()))
        table, old = table.take(pa.array(order)), int(np.flatnonzero(order == 0)[0]) if len(order) else 0
        token, v = table.column(0).to_numpy(), table.column(1).to_numpy()
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (v[1:] != v[:-1])
        old = int(new[:old].sum())  # where the row from before is; of equal rows it is the first
        table, token = table.filter(pa.array(new)), token[new]
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        last_kept = bool(keep[-1]) or (len(token) == 1 and given)
        if held is not None and given:
            keep[old] = False
        found = table.filter(pa.array(keep))
        if found.num_rows:
            yield found.combine_chunks().to_batches()[0]
        held, given = table.slice(len(token) - 1).combine_chunks().to_batches()[0], last_kept


def listed_tokens(rows: DataFrame, order: tuple[np.ndarray, np.ndarray], renamed: list[bytes]) -> DataFrame:
    """token, id, n, rest of the listed tokens that several vertices share, stored."""
    known = rows.sparkSession.sparkContext.broadcast((*order, set(renamed), NUMBER_BITS))
    first = rows.select("text").mapInArrow(lambda batches: _first_tokens(batches, known), _LISTED_DDL)
    dealt = first.repartition("token").sortWithinPartitions("token")
    return stored(dealt.mapInArrow(_shared_tokens, _LISTED_DDL), "listed-tokens")


@arrow_udf(_VERTEX)
def vertex(text: pa.Array) -> pa.Array:
    """The size of a text's set and the name of its vertex."""
    sets = list(sets_of(texts_as_bytes(text)))
    return pa.StructArray.from_arrays(
        [pa.array([len(s) for s in sets], pa.int64()), pa.array([set_name(s) for s in sets], pa.binary())], _VERTEX.names
    )


def vertex_texts(rows: DataFrame, named: DataFrame, found: DataFrame, listed: DataFrame) -> DataFrame:
    """id, text of the vertices that share a listed token, stored."""
    asked = listed.groupBy("id").agg(F.lit(1).alias("one")).select("id")
    wanted = stored(found.join(asked, "id", "left_semi").select("doc_id", "v", "id"), "wanted")
    repeated = stored(named.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select("doc_id"), "repeated-ids")
    plain = wanted.filter("doc_id IS NOT NULL").join(repeated, "doc_id", "left_anti").select("doc_id", "id")
    texts = rows.join(plain.hint("merge"), "doc_id").select("id", "text")
    odd = wanted.join(repeated.withColumnRenamed("doc_id", "again"), F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
    if not odd.isEmpty():
        # a text of such an id counts only for the vertex that its own set names
        several = rows.join(repeated.withColumnRenamed("doc_id", "again"), F.col("doc_id").eqNullSafe(F.col("again")), "left_semi")
        own = stored(several.select(vertex("text")["v"].alias("v"), "text"), "repeated-texts")
        texts = texts.unionByName(own.join(odd.select("v", "id"), "v").groupBy("id").agg(F.first("text").alias("text")))
    result = stored(texts, "vertex-texts")
    discard(wanted, repeated)
    return result


# ---- open groups: all links between, or in, groups of whole sets


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of every set on the left with every other one on the right; neither side is empty."""
    out = np.zeros((len(left), len(right)), np.float32)
    if left is right:
        tokens, held_by = np.unique(np.concatenate(left), return_counts=True)
        tokens = tokens[held_by > 1]
    else:
        tokens = np.intersect1d(np.concatenate(left), np.concatenate(right))

    def entries(side: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        row, every = np.repeat(np.arange(len(side)), [len(s) for s in side]), np.concatenate(side)
        at = np.minimum(np.searchsorted(tokens, every), len(tokens) - 1)
        held = tokens[at] == every
        row, at = row[held], at[held]
        order = np.argsort(at, kind="stable")
        return row[order], at[order]

    if not len(tokens):
        return out
    sides = [entries(left), entries(right)]
    for start in range(0, len(tokens), COLUMNS):
        width = min(COLUMNS, len(tokens) - start)
        dense = []
        for (row, at), side in zip(sides, (left, right)):
            a, b = np.searchsorted(at, [start, start + width])
            m = np.zeros((len(side), width), np.float32)
            m[row[a:b], at[a:b] - start] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def qualifying(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """The sets whose overlap with the union of all tokens of the other group allows a link with a set of its sizes."""
    union = np.unique(np.concatenate(others))
    sizes = np.array([len(s) for s in others])
    least, most = sizes.min(), sizes.max()
    keep = []
    for i, s in enumerate(sets):
        n = len(s)
        if DENOMINATOR * most < NUMERATOR * n or DENOMINATOR * n < NUMERATOR * least:
            continue
        at = np.minimum(np.searchsorted(union, s), len(union) - 1)
        bound = int((union[at] == s).sum())
        other = max(int(least), -(-NUMERATOR * n // DENOMINATOR))
        if bound * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n + other):
            keep.append(i)
    return np.array(keep, int)


def group_links(texts: list[bytes | None], component: list[int], side: list[int]) -> list[tuple[int, int]]:
    """Pairs of rows of side 0 and side 1 (or all of side 0, if there is no other) that join all components that links join."""
    sets = list(sets_of(texts))
    one, two = ([i for i, s in enumerate(side) if s == k] for k in (0, 1))
    if not one:
        return []
    if two:
        one = [one[i] for i in qualifying([sets[i] for i in one], [sets[i] for i in two])]
        two = [two[i] for i in qualifying([sets[i] for i in two], [sets[i] for i in one])] if one else []
        if not two:
            return []
    else:
        two = one
    root: dict[int, int] = {}

    def find(i: int) -> int:
        while root.get(i, i) != i:
            i = root[i]
        return i

    left = [sets[i] for i in one]
    common = overlaps(left, [sets[i] for i in two] if two is not one else left).astype(_LONG)
    n, m = (np.array([len(sets[i]) for i in rows]) for rows in (one, two))
    parts = np.array(component)
    found = DENOMINATOR * common >= NUMERATOR * (n[:, None] + m[None, :] - common)
    links = []
    for x, y in np.argwhere(found & (parts[one][:, None] != parts[two][None, :])).tolist():
        a, b = one[x], two[y]
        if (p := find(component[a])) != (q := find(component[b])):
            root[p] = q
            links.append((a, b))
    return links


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (piece, side, id, c, text) sorted by piece: the links (a, b) of each."""
    piece, held = None, ([], [], [], [])

    def told() -> Iterator[pa.RecordBatch]:
        ids, component, side, texts = held
        if links := group_links(texts, component, side):
            yield pa.RecordBatch.from_arrays([pa.array([ids[link[k]] for link in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        pieces, sides, ids, cs = (batch.column(k).to_pylist() for k in range(4))
        for i, text in enumerate(texts_as_bytes(batch.column(4))):
            if pieces[i] != piece:
                yield from told()
                piece, held = pieces[i], ([], [], [], [])
            for own, value in zip(held, (ids[i], cs[i], sides[i], text)):
                own.append(value)
    yield from told()


def opened(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b), stored, of open groups; members is piece, side, id, c."""
    sent = members.join(texts.hint("merge"), "id").select("piece", "side", "id", "c", "text")
    dealt = sent.repartition("piece").sortWithinPartitions("piece", "side", "id")
    return stored(dealt.mapInArrow(_opened, "a long, b long"), "links")


# ---- which groups there are, and which are opened


def _group_count() -> Column:
    return F.ceil(F.greatest(F.count(F.lit(1)) / GROUP_MEMBERS, F.sum("n") / GROUP_TOKENS)).alias("k")


def _most_shared(n: Column, m: Column, shared: Column) -> Column:
    """The greatest overlap of sets of at most n and m tokens that share so many listed ones: beyond the list
    that ends first lie no more tokens than that set does not list."""
    return shared + F.ceil(NUMERATOR * F.greatest(n, m) / DENOMINATOR) - 1


def _reaches(overlap: Column, n: Column, m: Column) -> Column:
    return overlap * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (n + m)


def best_leaders(labelled: DataFrame, round_: int) -> DataFrame:
    """id, c, n, leader, leader_c, shared: of the first vertices of its tokens in the round's order, that of another component with
    which a vertex shares most."""
    draw = F.xxhash64(F.lit(round_), "id")
    some = labelled.filter(F.pmod(F.xxhash64("token"), F.lit(LEADER_TOKENS)) == 0)
    first = some.groupBy("token").agg(F.min(F.struct(draw.alias("draw"), "id", "n", "c")).alias("first"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    first = first.filter("lo < hi").select("token", "first")
    agree = (DENOMINATOR * F.col("n") >= NUMERATOR * F.col("first.n")) & (DENOMINATOR * F.col("first.n") >= NUMERATOR * F.col("n"))
    met = some.join(first, "token").filter((F.col("c") != F.col("first.c")) & agree)
    shared = met.groupBy("id", F.col("first.id").alias("leader")).agg(
        F.count(F.lit(1)).alias("shared"), *[F.first(x).alias(x) for x in ("c", "n")], F.first("first.c").alias("leader_c")
    )
    best = F.max(F.struct("shared", "leader", "leader_c", "c", "n")).alias("best")
    return shared.groupBy("id").agg(best).select("id", "best.*")


def leader_groups(labelled: DataFrame, round_: int) -> DataFrame:
    """piece, side, id, c: each leader with its followers, in groups of bounded size; stored."""
    best = stored(best_leaders(labelled, round_), "leaders")
    sizes = best.groupBy("leader").agg(_group_count())
    own = best.join(sizes, "leader").withColumn("piece", F.xxhash64("leader", F.pmod(F.xxhash64("id"), "k")))
    leads = own.groupBy("piece", F.col("leader").alias("id")).agg(F.first("leader_c").alias("c"))
    both = own.select("piece", "id", "c").unionByName(leads.select("piece", "id", "c"))
    result = stored(both.select("piece", F.lit(0).alias("side"), "id", "c"), "leader-groups")
    discard(best)
    return result


def places(labelled: DataFrame) -> DataFrame:
    """id, c, n, p: the group of every vertex, stored."""
    members = labelled.groupBy("id").agg(F.first("c").alias("c"), F.first("n").alias("n"))
    votes = best_leaders(labelled, LEADER_ROUNDS).groupBy("c").agg(F.max(F.struct("shared", "leader_c")).alias("vote"))
    sizes = members.groupBy("c").agg((F.count(F.lit(1)) >= GROUP_MEMBERS).alias("large"))
    named = members.join(sizes.join(votes, "c", "left"), "c")
    step = _size_step(F.col("n"))
    label = F.when(F.col("large"), F.xxhash64(F.lit(1), "c", step)).otherwise(F.xxhash64(F.lit(2), F.coalesce("vote.leader_c", "c"), step))
    grouped = stored(named.select("id", "c", "n", "large", label.alias("g")), "grouped")
    draw = F.when(F.col("large"), F.xxhash64("id")).otherwise(F.xxhash64("c"))
    cut = grouped.join(grouped.groupBy("g").agg(_group_count()), "g")
    result = stored(cut.select("id", "c", "n", F.xxhash64("g", F.pmod(draw, "k")).alias("p")), "places")
    discard(grouped)
    return result


def matrix(labelled: DataFrame, placed_: DataFrame) -> DataFrame:
    """The token-group matrix: token, p, least and largest set that lists it, most that may follow, first and last component."""
    rows = labelled.drop("c").join(placed_.select("id", "c", "p"), "id")
    return rows.groupBy("token", "p").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.max("rest").alias("most"), F.min("c").alias("lo"), F.max("c").alias("hi")
    )


def _size_step(n: Column, parts: int = 1) -> Column:
    """Sets that can link are of the same size step or of neighbouring ones; a group's sets are all of one. Steps may be cut in parts."""
    return F.floor(parts * F.log(n.cast("double")) / math.log(DENOMINATOR / NUMERATOR))


def _met(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of cells whose groups, p <= q, have sets of different components and of sizes that allow a link."""
    a, b = (side.select(*on, *[F.col(c).alias(f"{c}_{k}") for c in ("p", "low", "high", "most", "lo", "hi")]) for side, k in ((a, "a"), (b, "b")))
    differ = F.least("lo_a", "lo_b") < F.greatest("hi_a", "hi_b")
    sizes = (DENOMINATOR * F.col("high_a") >= NUMERATOR * F.col("low_b")) & (DENOMINATOR * F.col("high_b") >= NUMERATOR * F.col("low_a"))
    follow = _reaches(F.least("most_a", "most_b"), F.col("low_a"), F.col("low_b"))
    met = a.join(b, on).filter((F.col("p_a") <= F.col("p_b")) & differ & sizes)
    return met.select(F.col("p_a").alias("p"), F.col("p_b").alias("q"), follow.alias("follow"), "low_a", "low_b", "high_a", "high_b")


def _met_common(cells: DataFrame) -> DataFrame:
    """Of the tokens that many groups list, the pairs of cells that follow: each cell meets only the sizes that it can follow with."""
    part = _size_step(F.col("low"), STEP_PARTS)
    largest = (F.col("most") * (NUMERATOR + DENOMINATOR) - F.col("low") * NUMERATOR) / NUMERATOR
    from_, to = part - 2 * STEP_PARTS - 1, F.least(part + 2 * STEP_PARTS + 1, _size_step(largest, STEP_PARTS) + 1)
    able = cells.filter(largest >= 1).withColumns({"from": from_, "to": to}).filter(F.col("from") <= F.col("to"))
    return _met(able.withColumn("part", F.explode(F.sequence("from", "to"))), cells.withColumn("part", part), ["token", "part"]).filter("follow")


def open_groups(cells: DataFrame) -> DataFrame:
    """Pairs (p, q) of groups, p <= q, whose listed tokens allow a link of different components; cells is the matrix, stored.

    Tokens that more than COMMON groups list are not summed pair by pair: a pair that shares such a token has at most as many
    of them in common as the group that lists fewer, and only those that a link can share first make pairs of their own.
    """
    counts = cells.groupBy("token").agg((F.count(F.lit(1)) > COMMON).alias("common"))
    marked = stored(cells.join(counts, "token"), "marked")
    rare, common = marked.filter("NOT common").drop("common"), marked.filter("common").drop("common")
    met = _met(rare, rare, ["token"]).withColumn("one", F.lit(1)).unionByName(_met_common(common).withColumn("one", F.lit(0)))
    summed = met.groupBy("p", "q").agg(
        F.sum("one").alias("shared"),
        F.max("follow").alias("follow"),  # true of the first token that a link's ends share
        *[f(c).alias(c) for f, c in ((F.min, "low_a"), (F.min, "low_b"), (F.max, "high_a"), (F.max, "high_b"))],
    )
    listed = common.groupBy("p").agg(F.count(F.lit(1)).alias("k_a"))
    summed = summed.filter("follow").join(listed, "p", "left")
    summed = summed.join(listed.select(F.col("p").alias("q"), F.col("k_a").alias("k_b")), "q", "left")
    shared = F.col("shared") + F.least(F.coalesce("k_a", F.lit(0)), F.coalesce("k_b", F.lit(0)))
    most = _most_shared(F.col("high_a"), F.col("high_b"), shared)
    result = stored(summed.filter(_reaches(most, F.col("low_a"), F.col("low_b"))).select("p", "q"), "open-groups")
    discard(marked)
    return result


def meetings(pairs: DataFrame, where: DataFrame) -> DataFrame:
    """piece, side, id, c: where the members of open groups (p, q) meet, stored; where is id, c, n, p.

    The larger group of a pair is the host.  The members of all groups that visit a host are dealt into parts of bounded
    size, and the host meets each part once: it is not sent anew to every small group that is opened to it.
    """
    sizes = where.groupBy("p").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    sizes = sizes.select("p", F.struct("members", "p", "n").alias("size"))
    sized = pairs.filter("p < q").join(sizes, "p").join(sizes.toDF("q", "other"), "q")
    host, guest = F.greatest("size", "other"), F.least("size", "other")
    visits = stored(sized.select(host["p"].alias("host"), guest.alias("guest")).select("host", "guest.*"), "visits")
    parts = F.ceil(F.greatest(F.sum("members") / GROUP_MEMBERS, F.sum("n") / GROUP_TOKENS)).alias("k")
    dealt = visits.select("host", "p").join(visits.groupBy("host").agg(parts), "host")
    part = F.pmod(F.xxhash64("id"), "k").alias("part")
    guests = stored(dealt.join(where.select("p", "id", "c"), "p").select("host", part, "id", "c"), "guests")
    met = guests.groupBy("host", "part").agg(F.lit(1).alias("one")).select(F.col("host").alias("p"), "part")
    alone = pairs.filter("p = q").select("p", F.lit(-1).cast("long").alias("part"))
    hosts = met.unionByName(alone).join(where.select("p", "id", "c"), "p")
    rows = guests.select(F.xxhash64("host", "part").alias("piece"), F.lit(1).alias("side"), "id", "c").unionByName(
        hosts.select(F.xxhash64("p", "part").alias("piece"), F.lit(0).alias("side"), "id", "c")
    )
    result = stored(rows, "matrix-groups")
    discard(visits, guests)
    return result


def matrix_groups(labelled: DataFrame) -> DataFrame:
    """piece, side, id, c: the members of groups that are opened to each other or to themselves."""
    where = places(labelled)
    cells = stored(matrix(labelled, where), "matrix")
    pairs = open_groups(cells)
    discard(cells)
    result = meetings(pairs, where)
    discard(where, pairs)
    return result


def vertex_components(docs: DataFrame, named: DataFrame, found: DataFrame, order: tuple[np.ndarray, np.ndarray], renamed: list[bytes]) -> DataFrame | None:
    """v (an id), c of every vertex that has a link (None: there are none)."""
    rows = _rows(docs)
    listed = listed_tokens(rows, order, renamed)
    release(docs.sparkSession)
    texts = vertex_texts(rows, named, found, listed)
    release(docs.sparkSession)
    edges = groups = None
    for step in range(LEADER_ROUNDS + 1):
        if groups is None:
            labelled = listed.withColumn("c", F.col("id"))
        else:
            labels = groups.select(F.col("v").alias("id"), "c")
            named_rows = listed.join(labels, "id", "left").withColumn("c", F.coalesce("c", "id"))
            mixed = named_rows.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("token")
            labelled = stored(named_rows.join(mixed, "token"), "labelled")
        members = leader_groups(labelled, step) if step < LEADER_ROUNDS else matrix_groups(labelled)
        new = opened(members, texts)
        discard(members, labelled if groups is not None else None)
        if new.isEmpty():
            continue
        edges = new if edges is None else edges.unionByName(new)
        discard(groups)
        groups = components(edges)
        release(docs.sparkSession)
    discard(listed, texts)
    return groups


def placed(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, v, c (its component) and component_id."""
    listing = vertices(docs)
    order = token_order(listing)
    named = stored(listing.drop("first"), "named")
    discard(listing)
    found, renamed = numbered(named)
    groups = vertex_components(docs, named, found, order, renamed)
    whole = found.select("v", "id", "doc_id")
    if groups is None:
        classes = whole.select("v", F.col("id").alias("c"), F.col("doc_id").alias("least"))
    else:
        own = whole.join(groups.select(F.col("v").alias("id"), "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
        classes = own.join(own.groupBy("c").agg(F.min("doc_id").alias("least")), "c").select("v", "c", "least")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return named.join(classes, "v", "left").select("doc_id", "n_shingles", "v", "c", component.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, component_id."""
    return placed(docs).select("doc_id", "n_shingles", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: one of each component, that of smallest doc_id, and all without words.

    Where several rows have that id, or no row of a component has one, any one of them stays.
    """
    found = stored(placed(docs).filter("n_shingles > 0"), "placed")
    ties = found.filter("doc_id <=> component_id").groupBy("c").count().filter("count > 1")
    by_vertex = found.groupBy("v").agg(F.first("c").alias("c"), F.first("component_id").alias("component_id"))
    own, v, c, least = (fresh_name(docs, stem) for stem in ("vertex_", "v_", "c_", "component_"))
    marked = docs.withColumn(own, vertex(F.col("text").cast("string"))).join(
        by_vertex.toDF(v, c, least), F.col(f"{own}.v") == F.col(v), "left"
    )
    empty = F.col(f"{own}.n") == 0
    stay = F.col("doc_id").cast("long").eqNullSafe(F.col(least))
    kept = marked.filter(empty | stay)
    if not ties.isEmpty():
        kept = marked.filter(empty).unionByName(marked.filter(~empty & stay).dropDuplicates([c]))
    return kept.select(*docs.columns)

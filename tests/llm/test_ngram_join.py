from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from sieveline.llm import ngram_join
from sieveline.llm.ngram_join import drop_near_duplicates, near_duplicates
from sieveline.llm.shingles import shingle_sets, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def family(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k : k + rng.choice([0, 1])] = [f"x{rng.randrange(999)}"]
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl") + rng.choice(["", "é", "1", "q"])
    passage = " ".join(word() for _ in range(30))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([8, 30, 90, 200]))]
        texts += [family(rng, base, rng.randrange(0, 1 + len(base) // 12)) for _ in range(rng.choice([1, 3, 12]))]
    texts += [passage + " " + " ".join(word() for _ in range(rng.randrange(2, 40))) for _ in range(25)]
    chain = [word() for _ in range(120)]
    texts += [" ".join(chain[i : i + 60]) for i in range(0, 60, 5)]  # each links with its neighbours only
    texts += ["a b", "A  b", "a b c", "one", None, "", " \n", "a b c d e", "Again again " * 6000]
    return [(i, t) for i, t in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rows = corpus(seed)
    rows += [(5000 + i, t) for i, t in rows[:10]] + [rows[3], (None, rows[0][1]), (None, "nobody else has these words at all"), (3, "other words for id three here")]
    rows = [(i if i is None else (i * 7919) % 100_003, t) for i, t in rows]
    assert sorted(map(tuple, near_duplicates(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_a_passage_of_many_texts_opens_groups_not_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_MEMBERS", 16)
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(10**6)}"
    passage = [word() for _ in range(80)]
    rows = []
    for i in range(700):  # alike, and some of them linked
        own = passage + [word() for _ in range(rng.choice([2, 6, 9, 14, 40]))]
        rows.append((i, family(rng, own, rng.choice([0, 0, 1, 3]))))
    assert sorted(map(tuple, near_duplicates(frame(spark, rows)).collect()), key=str) == brute(rows)


def test_sets_of_one_number_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "NUMBER_BITS", 5)
    rows = corpus(1)[:60]
    found, renamed = ngram_join.numbered(ngram_join.vertices(frame(spark, rows)))
    assert renamed and found.select("id").distinct().count() == found.count()
    numbers = {bytes(r.v): r.id for r in found.collect()}
    assert all(ngram_join.number_of(v, set(renamed), 5) == i for v, i in numbers.items())
    assert sorted(map(tuple, near_duplicates(frame(spark, rows)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("columns", [3, 4096])
def test_open_groups_find_all_links(monkeypatch, columns):
    monkeypatch.setattr(ngram_join, "COLUMNS", columns)
    rng = np.random.default_rng(5)
    bases = [rng.choice(400, 40, replace=False).astype(np.uint64) for _ in range(3)]
    sets = [np.unique(np.concatenate([rng.permutation(bases[i % 3])[: rng.integers(30, 41)], rng.integers(0, 400, 3).astype(np.uint64)])) for i in range(40)]
    monkeypatch.setattr(ngram_join, "sets_of", lambda texts: iter([sets[t] for t in texts]))
    link = lambda a, b: 175 * len(np.intersect1d(sets[a], sets[b])) >= 75 * (len(sets[a]) + len(sets[b]))
    for side in ([0] * 40, [int(i > 17) for i in range(40)]):
        got = ngram_join.group_links(list(range(40)), list(range(40)), side)
        want = [(a, b) for a in range(40) for b in range(a) if link(a, b) and (not any(side) or side[a] != side[b])]
        assert want and all(link(a, b) for a, b in got)
        assert partition(got) == partition(want)


def partition(links):
    root = list(range(40))
    for a, b in links:
        root = [root[a] if r == root[b] else r for r in root]
    return {frozenset(i for i in range(40) if root[i] == r) for r in root}


def test_one_row_of_each_component_stays(spark):
    rows = corpus(3)
    want = {c for _, n, c in brute(rows) if n} | {i for i, n, _ in brute(rows) if not n}
    extra = spark.createDataFrame([(i, t, i, "s") for i, t in rows], "doc_id long, text string, v_ long, Component_ string")
    kept = drop_near_duplicates(extra)
    assert kept.columns == extra.columns and sorted(r.doc_id for r in kept.collect()) == sorted(want)
    tied = frame(spark, [(1, "p q r s t u"), (1, "p q r s t u"), (None, "k l m"), (None, "k l m"), (None, None)])
    assert sorted((str(r.doc_id), str(r.text)) for r in drop_near_duplicates(tied).collect()) == [("1", "p q r s t u"), ("None", "None"), ("None", "k l m")]


def test_empty_and_unlinked_tables(spark):
    none = frame(spark, corpus(1)).limit(0)
    assert near_duplicates(none).count() == 0 and drop_near_duplicates(none).count() == 0
    lone = frame(spark, [(4, "only one text here now"), (5, "and another that differs")])
    assert sorted(map(tuple, near_duplicates(lone).collect())) == [(4, 1, 4), (5, 1, 5)]


def test_shared_tokens_across_batches():
    rng = np.random.default_rng(3)
    token, v = np.sort(rng.integers(0, 60, 400)), rng.integers(0, 3, 400)
    rows = sorted(zip(token.tolist(), v.tolist()))
    seen = {}
    for t, x in rows:
        seen.setdefault(t, set()).add(x)
    want = [(t, x) for t, x in sorted(set(rows)) if len(seen[t]) > 1]
    for size in (1, 2, 7, 400):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*p)], ["token", "v"]) for p in parts]
        got = [(r["token"], r["v"]) for b in ngram_join._shared_tokens(iter(batches)) for r in b.to_pylist()]
        assert got == want


def test_hashes_depend_on_words_alone():
    a, _ = word_hashes([[b"x", b"yy"], [], [b"\xc3\xa9"]])
    b, counts = word_hashes([[b"\xc3\xa9"], [b"yy", b"x"]])
    assert a.tolist() == [b[2], b[1], b[0]] and counts.tolist() == [1, 2] and len(set(a.tolist())) == 3
    sets = shingle_sets([[b"a"] * 9, [b"a"] * 5, [b"a"] * 4, []], 5)
    assert [len(s) for s in sets] == [1, 1, 1, 0] and sets[0].tolist() == sets[1].tolist() != sets[2].tolist()


def test_groups_of_a_common_token_are_not_all_paired(spark):
    """A token of 200 groups, which few sets can share first, makes no row for each two of them."""
    rng = random.Random(8)
    rows = []
    for p in range(200):
        n = rng.randrange(66, 110)
        rows.append((1, p, n, n + rng.randrange(3), 62, p, p))  # 62 tokens from the common one on
        rows += [(rng.randrange(2, 60), p, n, n + 2, n - rng.randrange(12), p, p) for _ in range(3)]
    names = ["token", "p", "low", "high", "most", "lo", "hi"]
    cells = {(r[0], r[1]): dict(zip(names, r)) for r in rows}
    ddl = "token long, p long, low int, high int, most int, lo long, hi long"
    frame = spark.createDataFrame([tuple(c.values()) for c in cells.values()], ddl)
    got = {(r.p, r.q) for r in ngram_join.open_groups(frame).collect()}

    shared = {}
    for (token, p), a in cells.items():
        for (other, q), b in cells.items():
            if token == other and p < q and 100 * a["high"] >= 75 * b["low"] and 100 * b["high"] >= 75 * a["low"]:
                shared.setdefault((p, q), []).append((a, b))
    want = set()
    for pair, both in shared.items():
        follow = any(min(a["most"], b["most"]) * 175 >= 75 * (a["low"] + b["low"]) for a, b in both)
        high = max(x["high"] for ab in both for x in ab)
        low = min(a["low"] for a, _ in both) + min(b["low"] for _, b in both)
        if follow and (len(both) + -(-75 * high // 100) - 1) * 175 >= 75 * low:
            want.add(pair)
    assert want <= got and len(got) <= 1.2 * len(want)
    common = frame.filter("token = 1")
    followed = {(p, q) for (p, q), both in shared.items() for a, b in both if a["token"] == 1 and 62 * 175 >= 75 * (a["low"] + b["low"])}
    assert {(r.p, r.q) for r in ngram_join._met_common(common).collect()} == followed
    assert 0 < len(followed) < 200 * 199 / 2 / 4


def test_a_large_group_is_not_sent_to_each_group_opened_to_it(spark, monkeypatch):
    """One group of 40, with 120 of one or two members opened to it, all to their neighbours and some to themselves."""
    monkeypatch.setattr(ngram_join, "GROUP_MEMBERS", 40)
    members = {0: list(range(40))} | {g: [100 + 2 * g + i for i in range(1 + g % 2)] for g in range(1, 121)}
    pairs = [(0, g) for g in range(1, 121)] + [(g, g + 1) for g in range(1, 120)] + [(0, 0), (7, 7)]
    where = [(i, 1000 + i, 50, g) for g, ids in members.items() for i in ids]
    monkeypatch.setattr(ngram_join, "places", lambda labelled: spark.createDataFrame(where, "id long, c long, n int, p long"))
    monkeypatch.setattr(ngram_join, "matrix", lambda labelled, placed: spark.range(1).toDF("token"))
    monkeypatch.setattr(ngram_join, "open_groups", lambda cells: spark.createDataFrame(pairs, "p long, q long"))
    rows = ngram_join.matrix_groups(None).collect()
    assert all(r.c == 1000 + r.id for r in rows)

    pieces = {}
    for r in rows:
        pieces.setdefault(r.piece, ([], []))[r.side].append(r.id)
    met = []
    for one, two in pieces.values():
        assert one and len(one) <= 40 and len(two) <= 2 * 40
        met += [tuple(sorted((a, b))) for a in one for b in two] if two else [(a, b) for a in one for b in one if a < b]
    want = [tuple(sorted((a, b))) for p, q in pairs if p != q for a in members[p] for b in members[q]]
    want += [(a, b) for p, q in pairs if p == q for a in members[p] for b in members[p] if a < b]
    assert sorted(met) == sorted(want)

    lesser = sum(min(len(members[p]), len(members[q])) for p, q in pairs if p != q)
    assert len(rows) <= 2 * lesser + 2 * len(where)  # 5,379 rows where each pair sends both of its groups

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import minhash_dedup
from sieveline.llm.minhash_dedup import band_keys, estimates, minima, near_duplicates, signatures

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(w) < 3:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)]
    return sorted(((d, n, c, d == c) for d, n, c in out), key=str)


def changed(rng, base, edits):
    w = list(base)
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k : k + rng.choice([0, 1])] = [f"x{rng.randrange(9999)}"]
    return " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghijkl") + rng.choice(["", "é", "1", "Q"])
    passage = " ".join(word() for _ in range(40))
    texts = []
    for _ in range(14):
        base = [word() for _ in range(rng.choice([4, 9, 30, 90, 200]))]
        texts += [changed(rng, base, rng.randrange(0, 1 + len(base) // 12)) for _ in range(rng.choice([1, 3, 14]))]
    base = [word() for _ in range(150)]
    texts += [changed(rng, base, rng.randrange(0, 9)) for _ in range(60)]
    texts += [" ".join(word() for _ in range(rng.randrange(5, 40))) + " " + passage for _ in range(30)]
    texts += rng.sample(texts, 12) + [t.upper() for t in rng.sample(texts, 5)] + ["a", "a b", "a b c", "b", "", " \n", None, None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(None, texts[3]), (None, None), (rows[0][0], rows[0][1]), (rows[1][0], rows[2][1]), (None, "only here and nowhere else")]


def got(spark, rows):
    docs = spark.createDataFrame([(*r, "x", b"y", 1) for r in rows], "doc_id long, text string, v string, keys binary, id int")
    return sorted((tuple(r) for r in near_duplicates(docs.repartition(6)).collect()), key=str)


@pytest.mark.parametrize("seed, rounds, chunk, cell", [(1, 2, 1024, 256), (2, 0, 16, 8), (3, 1, 7, 5)])
def test_components_are_those_of_brute_force(spark, monkeypatch, seed, rounds, chunk, cell):
    monkeypatch.setattr(minhash_dedup, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(minhash_dedup, "BUCKET_CHUNK", chunk)
    monkeypatch.setattr(minhash_dedup, "CELL_TEXTS", cell)
    rows = corpus(seed)
    expected = brute(rows)
    # a row without id and component names no component, as the rule "kept = doc_id names it" has it
    expected = sorted(((d, n, c, d == c) for d, n, c, _ in expected), key=str)
    assert got(spark, rows) == expected
    assert max(Counter(r[2] for r in expected).values()) > 20


def test_a_passage_that_thousands_share_and_a_long_text(spark):
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(30)) + " " + passage) for i in range(2000)]
    long = [f"l{i % 70001}" for i in range(150_000)]
    rows += [(5000, " ".join(long)), (5001, " ".join(long[2000:])), (5002, " ".join(long[90_000:]))]
    found = {r[0]: r for r in got(spark, rows)}
    assert all(found[i][2] == i for i in range(2000))
    assert [found[i][2:] for i in (5000, 5001, 5002)] == [(5000, True), (5000, False), (5000, False)]
    assert found[5000][1] == 70001


def test_empty_tables_and_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_estimates_correct_for_chance_agreement():
    rng = np.random.default_rng(4)
    for share in (0.0, 0.3, 0.85, 0.95, 1.0):
        found = []
        for _ in range(20):
            common, x, y = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (round(400 * share), *[200 - round(200 * share)] * 2))
            low = minima([np.concatenate([common, x]), np.concatenate([common, y])])
            packed = signatures(low)
            found.append(estimates(packed[0], packed[1]))
        assert abs(np.mean(found) - share) < 0.02 and np.std(found) < 0.035


def test_pairs_at_the_threshold_share_a_bucket():
    rng = np.random.default_rng(6)
    for _ in range(300):
        common, x, y = (rng.integers(0, 2**63, k, dtype=np.uint64) for k in (170, 15, 15))
        keys = band_keys(minima([np.concatenate([common, x]), np.concatenate([common, y])]))
        assert (keys[0] == keys[1]).any()

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from sieveline.llm import ranked_search
from sieveline.llm.ranked_search import ShardIndex, _numbers, build_index, search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """Scores of every document for every item."""
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, c.total()) for d, c in held if c]
    total = sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scores = []
        for d, c, n in held:
            m = 10 + (90 * n * len(held)) // total
            s = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own & c.keys()
            )
            if s > 0:
                scores.append((s, d))
        scores.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        out += [(item, rank, d, s) for rank, (s, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n=250):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(120)] + ["Été", "日本", "x1"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    text = lambda most: rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, weights, k=rng.randrange(1, most)))
    docs = [(i, text(60)) for i in range(n)]
    docs += [(n + i, docs[i][1]) for i in range(20)] + [(n + 30, None), (n + 31, ""), (n + 32, " ,; "), (None, docs[3][1]), (7, docs[7][1])]
    items = [(i, text(25)) for i in range(25)] + [(40, None), (41, "nothing-here"), (42, "w0 W0 w1"), (3, "w50 w51"), (None, "w9 w100 été")]
    items += [(43, docs[5][1])]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(*r, "en", 1) for r in docs], "doc_id long, text string, score string, rank int").repartition(5),
        spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, score int"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("postings, block", [(1 << 20, 4_000_000), (200, 4_000_000), (1000, 60)])
def test_results_are_those_of_brute_force(spark, monkeypatch, postings, block):
    monkeypatch.setattr(ranked_search, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked_search, "ITEM_TERMS", block)
    for seed in (1, 2) if postings == 200 else (3,):
        docs, items = corpus(seed)
        assert rows(search(*frames(spark, docs, items))) == brute(docs, items)
    assert rows(search(*frames(spark, docs, items), k=3)) == brute(docs, items, 3)


def test_ties_take_ascending_ids_and_small_tables_give_what_there_is(spark):
    docs = [(i, "same text here") for i in (9, 4, 30, 2, 11)] + [(100, "other words"), (101, "other words")]
    items = [(1, "same"), (2, "absent")]
    assert [r[2] for r in sorted(rows(search(*frames(spark, docs, items))), key=lambda r: r[1])] == [2, 4, 9, 11, 30]
    one, asked = frames(spark, docs, items)
    assert rows(search(one.limit(0), asked)) == []
    assert rows(search(one, asked.limit(0))) == []
    assert search(one, asked.limit(0)).schema == search(one, asked).schema


def test_very_long_documents(spark):
    docs = [(1, "needle " + "hay " * 400_000), (2, "needle pin"), (3, "hay")]
    items = [(1, "needle hay")]
    assert rows(search(*frames(spark, docs, items))) == brute(docs, items)


def shard(spark, docs, items):
    vocabulary = sorted({t.encode() for _, text in items for t in terms(text)})
    number = {t: i for i, t in enumerate(vocabulary)}
    asked = [np.array(sorted(number[t.encode()] for t in set(terms(text))), np.int32) for _, text in items]
    docs, _ = frames(spark, docs, items)
    index, weights = build_index(docs.coalesce(1), vocabulary, asked)
    (row,) = index.collect()
    kinds = ("<i4", "<i8", "<i4", "<i8", "<i8", "<i8", "<i8", "<i4")
    return ShardIndex(row[0], *[_numbers(a, k) for a, k in zip(row[1:], kinds, strict=True)], len(weights)), asked, weights


def test_pair_bounds_hold_are_tighter_and_skip_more(spark):
    """Two common terms that never meet: each alone is strong, but no document has both."""
    docs = [(i, "rare0 left filler") for i in range(12)] + [(50 + i, "rare0 words filler only") for i in range(290)]
    docs += [(1000 + i, " ".join(["left" if i % 9 < 4 else "right"] * 4)) for i in range(900)]
    docs += [(3000 + i, "filler words only") for i in range(3000)]
    index, asked, weights = shard(spark, docs, [(1, "rare0 left right")])
    terms_ = ranked_search._ordered(asked[0], weights)
    lists = [index.lists.find(t)[0] for t in terms_]
    bound = index.bounds([int(t) for t in terms_], lists)
    assert bound[1] < sum(int(index.most[at]) for at in lists[1:])
    top = index.top(terms_, 10)
    with_pairs, index.scored = index.scored, 0
    index.pairs.keys = np.zeros(0, np.int64)
    assert index.top(terms_, 10) == top
    assert with_pairs < index.scored
    score = np.zeros(len(index.ids), np.int64)
    for t in terms_[1:]:
        _, a, b = index.lists.find(t)
        score[index.lists.values[0][a:b]] += index.lists.values[1][a:b]
    assert score.max() <= bound[1]

from __future__ import annotations

import hashlib
import random
import re

import pytest

from sieveline.llm.decontaminate import WuManber, contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item_id, item in items:
            iw = words(item)
            k = min(10, len(iw))
            for j in range(len(iw) - k + 1 if k else 0):
                for i in range(len(w) - k + 1):
                    if w[i : i + k] == iw[j : j + k]:
                        hit |= set(range(i, i + k))
                        ids.add("" if item_id is None else str(item_id))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "éa", "x9", "the", "Über"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "\n", "\x00"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 4, 10, 11, 25]))) for i in range(12)] + [(3, text(12)), (None, text(14)), (40, None)]
    docs = [(i, text(rng.randrange(40))) for i in range(30)]
    docs += [(50 + i, "zz " + (t or "") + " qq") for i, (_, t) in enumerate(items)]
    docs += [(90, None), (91, ""), (None, items[5][1]), (92, "w " * 60_000 + (items[5][1] or "")), (92, "w")]
    return docs, items


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_equals_brute_force_with_one_or_many_blocks(spark, block_bytes):
    docs, items = corpus(1)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, contamination(d, b, block_bytes).collect()), key=str)
    assert got == brute(docs, items)


def test_search_finds_overlaps_repeats_and_short_patterns():
    rng = random.Random(7)
    text = bytes(rng.choice(b"ab ") for _ in range(5000))
    patterns = sorted({text[i : i + rng.randrange(1, 30)] for i in range(0, 4000, 37)})
    brute_found = {(i, k) for k, p in enumerate(patterns) for i in range(len(text)) if text.startswith(p, i)}
    found = WuManber(patterns).find(text)
    assert set(found) == brute_found and len(found) == len(brute_found)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two", "s", 3), (2, None, "t", 4)], "doc_id long, text string, scan_ string, Digest_ long")
    none = spark.createDataFrame([], "item_id long, text string")
    items = spark.createDataFrame([(1, "two")], "item_id long, text string")
    assert drop_contaminated(docs, none).count() == 2
    for block_bytes in (1, 100):
        assert [tuple(r) for r in drop_contaminated(docs, items, block_bytes).collect()] == [(2, None, "t", 4)]
    assert contamination(docs.limit(0), items).count() == 0

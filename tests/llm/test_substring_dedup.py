from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from sieveline.llm import substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k=50):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc_id, _), w in zip(rows, words):
        if doc_id is not None:
            for i in range(len(w) - k + 1):
                key = tuple(w[i : i + k])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if doc_id is not None and first[tuple(w[i : i + k])] < doc_id:
                gone[i : i + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if any(gone) else None))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "é", "x1", "the"]) + str(rng.randrange(12))
    own = lambda n: [word() for _ in range(n)]
    passages = [own(n) for n in (49, 50, 51, 64, 120, 300)]
    texts = []
    for _ in range(60):
        parts = [own(rng.randrange(60))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            cut = rng.randrange(3) * 10
            parts += [p[cut:] if rng.random() < 0.5 else p[: len(p) - cut], own(rng.choice([0, 1, 30]))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(w for p in parts for w in p))
    texts += [texts[3], texts[4], "  " + texts[5].replace(" ", "\n"), "short one", "short one", None, "", "w " * 5000, "w " * 49, "w " * 60]
    rng.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, N_words long").repartition(4)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    rows += [(None, rows[0][1]), (None, None), rows[7], (9, rows[11][1]), (2000, rows[9][1])]
    got = sorted(map(tuple, sd.remove_repeats(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_empty_and_clean_tables(spark):
    assert sd.remove_repeats(frame(spark, corpus(1)).limit(0)).count() == 0
    rows = [(1, "a b c"), (2, "d e f")]
    assert sorted(map(tuple, sd.remove_repeats(frame(spark, rows)).collect())) == brute(rows)


def test_minimizers_of_windows():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 130).astype(np.uint64)
    grams = sd.ngram_hashes(hashes, sd.SEED)
    got = sd.window_minimizers(hashes)
    assert got.tolist() == [grams[i : i + sd.K - sd.SEED + 1].min() for i in range(130 - sd.K + 1)]
    assert len(sd.window_minimizers(hashes[:49])) == 0 and len(sd.window_minimizers(hashes[:50])) == 1


def test_paths_break_at_branches_and_spans_are_verified(spark):
    rng = random.Random(8)
    own = lambda n: [f"v{rng.randrange(10**6)}" for _ in range(n)]
    p = own(100)
    rows = [(1, " ".join(p)), (2, " ".join(p[:70] + own(40))), (3, " ".join(own(30) + p[20:])), (4, " ".join(p[:70] + own(5)))]
    docs = frame(spark, rows)
    edges = sd.candidate_edges(docs, sd.documents(docs))
    each = sd.occurrences(edges)
    found = sd.spans(each, sd.compact(sd.repeated_edges(each)))
    got = sorted((r.doc, r.start, r.n_words, r.src_doc, r.src_start) for r in found.collect())
    assert got == [(2, 0, 70, 1, 0), (3, 30, 80, 1, 20), (4, 0, 70, 1, 0)]
    wrong = found.withColumn("src_start", found.src_start + (found.doc == 2).cast("int"))
    assert sorted(r.doc for r in sd.verified(wrong, edges).collect()) == [3, 4]


def near_copies():
    """Copies with words replaced in place, some of which are copied again."""
    rng = random.Random(11)
    p = [f"u{i}" for i in range(400)]

    def changed(words, *at):
        return [f"new{rng.randrange(10**6)}" if i in at else w for i, w in enumerate(words)]

    once = changed(p, 100)
    texts = [p, once, changed(p, 300), changed(p, 60, 130, 131, 330), changed(once, 250), changed(p, 20, 390), changed(p, *range(0, 400, 45))]
    return [(i, " ".join(w)) for i, w in enumerate(texts, 1)]


def test_near_copies_with_replaced_words(spark):
    rows = near_copies()
    want = brute(rows)
    assert [r[2] for r in want][:3] == [0, 399, 399]
    assert sorted(map(tuple, sd.remove_repeats(frame(spark, rows)).collect()), key=str) == want


def test_windows_of_a_failed_span_are_checked_one_by_one(spark):
    rows = near_copies()[:2]
    docs = frame(spark, rows)
    edges = sd.candidate_edges(docs, sd.documents(docs))
    bridged = spark.createDataFrame([(2, edges.filter("doc = 2").first().c, 0, 400, 1, edges.filter("doc = 1").first().c, 0)], "doc long, c long, start int, n_words int, src_doc long, src_c long, src_start int")
    good = sd.verified(bridged, edges)
    assert good.count() == 0
    single = sd.parts(bridged, good)
    assert sorted(r.start for r in sd.verified(single, edges).collect()) == [*range(0, 51), *range(101, 351)]
    assert sd.parts(single.filter("start = 0"), sd.verified(single, edges)) is None

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np

from sieveline.llm.periodic_runs import Catchers, find_runs, repeating, summary, texts_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w):
    """Every run (start, length, smallest period), by comparing all words one period apart."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for a, k, q in runs for i in range(a + q, a + k)}
    best = (None,) * 4
    if runs:
        a, k, q = min(runs, key=lambda r: (-r[1] * 10**12 // r[2], r[0], r[2]))
        best = a, k, q, 1000 * k // q
    lines = "".join(f"{a},{k},{q}\n" for a, k, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, sha(lines), sha(kept))


def sample(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(60))]
    if kind == 1:
        return list("a" * rng.randrange(80))
    out = [rng.choice("abcde") for _ in range(rng.randrange(12))]
    for _ in range(rng.randrange(4)):
        part = [rng.choice("abcd") for _ in range(rng.randrange(1, 20))]
        out += (part * 9)[: int(len(part) * rng.uniform(2, 9))]
        out += [rng.choice("abcde") for _ in range(rng.randrange(3))]
    return out


def as_triples(runs):
    return [(a, b - a, q) for a, b, q in runs.tolist()]


def test_runs_are_those_of_brute_force_however_words_are_appended():
    rng = random.Random(5)
    for _ in range(400):
        w = sample(rng)
        numbers = np.array([ord(c) for c in w], np.int64)
        expected = brute_runs(w)
        for sizes in ([len(w)], [1] * len(w), [rng.randrange(1, 9) for _ in range(len(w))]):
            catchers, at = Catchers(), 0
            for k in sizes:
                catchers.append(numbers[at : at + k])
                at += k
            assert sorted(as_triples(catchers.runs())) == expected


def test_runs_reported_before_the_end_are_those_of_the_words_so_far():
    w = list("xy" + "abc" * 6 + "ab" + "a" * 9 + "zz")
    catchers = Catchers()
    for i, c in enumerate(w):
        catchers.append(np.array([ord(c)]))
        assert sorted(as_triples(catchers.runs())) == brute_runs(w[: i + 1])


def test_many_texts_share_a_sequence_and_no_run_crosses_them():
    rng = random.Random(9)
    texts = [" ".join(sample(rng)).encode() for _ in range(300)] + [None, b"", b"a a a", b"a a a", b"a a a a a a"]
    for text, (words, runs) in zip(texts, texts_runs(texts), strict=True):
        assert words == (text or b"").split()
        assert sorted(as_triples(runs)) == brute_runs(words)


def test_hash_clashes_do_not_make_runs():
    """Thue-Morse words and their complements have equal sums of powers; the words are compared as well."""
    m = [0]
    while len(m) < 4096:
        m += [1 - x for x in m]
    w = (m + [1 - x for x in m]) * 2
    catchers = Catchers()
    catchers.append(np.array(w))
    assert catchers.runs().tolist() == []


def test_very_long_texts():
    period = [f"w{i}" for i in range(60_000)]
    text = " ".join(["x"] * 50_000 + period * 5).encode()
    ((words, runs),) = texts_runs([text])
    assert as_triples(runs) == [(0, 50_000, 1), (50_000, 300_000, 60_000)]


def test_query_is_that_of_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice([" ", "\t\n", " \x0b "]).join(sample(rng))) for i in range(300)]
    rows += [(i, "é " * rng.randrange(40) + " b  ") for i in range(300, 330)]
    rows += [(400, None), (401, ""), (402, " \n"), (None, "a " * 7), (None, None), (5, rows[5][1]), (5, "b b b b b b")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, r int")
    out = summary(find_runs(docs, repeating("doc_id", "text")))
    got = [tuple(r)[:8] for r in out.collect()]
    assert sorted(got, key=str) == sorted((brute(*r) for r in rows), key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10
    empty = summary(find_runs(docs.limit(0), repeating("doc_id", "text")))
    assert empty.count() == 0 and empty.schema == out.schema

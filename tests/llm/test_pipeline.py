from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from sieveline.llm import language_id, sentencepiece_codec

LOWER = {c: c + 32 for c in range(65, 91)}
SYLLABLES = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["ber", "sch", "ung", "ein", "kei"]}


def say(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def make(seed):
    rng = random.Random(seed)
    items = [(i, say(rng, "aa", rng.randrange(8, 30))) for i in range(6)]
    docs = []
    for _ in range(220):
        lang = rng.choice(list(SYLLABLES))
        docs.append((say(rng, lang, rng.randrange(12, 80)), lang))
    for k in range(40):
        text, lang = docs[k]
        words = text.split()
        docs.append([(text.upper(), lang), (" ".join(words[:-1] + ["ka"]), lang), (text + " " + items[k % 6][1], lang), (text, None)][k % 4])
    docs += [(None, "aa"), ("", "bb"), ("12 + 3", "aa"), ("xyzq wvx qqq zzxy " * 9, None)]
    rng.shuffle(docs)
    return [(i, t, lang, f"s{i % 3}", len(t or "")) for i, (t, lang) in enumerate(docs)], items


def windows(w):
    k = min(10, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, rejected, items):
    rows = [r for r in rows if r[0] not in rejected]
    last = {}
    for r in rows:
        last[(r[1] or "").translate(LOWER)] = max(r[0], last.get((r[1] or "").translate(LOWER), r[0]))
    rows = [r for r in rows if last[(r[1] or "").translate(LOWER)] == r[0]]
    sets = {}
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r[1].translate(LOWER))
        sets[r[0]] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    rows = [r for r in rows if find(r[0]) == r[0]]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    bad = set().union(*(windows(word.findall(t.translate(LOWER))) for _, t in items))
    sizes = {len(b) for b in bad}
    kept = []
    for r in rows:
        w = word.findall(r[1].translate(LOWER))
        if not any(tuple(w[i : i + k]) in bad for k in sizes for i in range(len(w) - k + 1)):
            kept.append(r)
    return kept


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, items = make(4)
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_pipeline_equals_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rejected = {r.doc_id for r in language_id.predict(docs).filter("rejected").collect()}
    strange = {r[0] for r in rows if not re.search("[a-z]", (r[1] or "").lower()) or "xyzq" in r[1]}
    assert rejected == strange
    got = corpus_pipeline.run(spark, path)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids"]
    found = sorted(map(tuple, got.collect()))
    model = sentencepiece_codec.load()
    assert [r[:5] for r in found] == sorted(brute(rows, rejected, items))
    assert all(model.decode(r[5]) == r[1] for r in found)
    assert 100 < len(found) < 230


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
        assert stage(spark, docs.limit(0), path).count() == 0

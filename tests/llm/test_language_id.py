from __future__ import annotations

import math
import random
import tracemalloc
import weakref
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sieveline.llm import common
from sieveline.llm import language_id as li

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["ber", "sch", "ung", "ein"], "cc": ["éau", "ois", "que", "lle"]}


def say(lang, rng, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randrange(1, 4))) for _ in range(n))


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    return [(i, say(lang := rng.choice(list(SYLLABLES)), rng, rng.randrange(5, 60)), lang) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)


def test_held_out_texts_are_recognised_and_only_strange_ones_rejected(spark, rows):
    strange = [(1000, "wxyz qqxv zzzw " * 20, "aa"), (1001, None, "aa"), (1002, "12 % 7", None), (1003, "", "bb"), (None, say("bb", random.Random(1), 30), None)]
    docs = frame(spark, rows + strange + [rows[0]])
    got = {(r.doc_id): r for r in li.predict(docs).collect()}
    for doc_id, _, lang in rows:
        r = got[doc_id]
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert r.lang_pred == lang and not r.rejected and 0 < r.score <= 1
    assert got[1000].rejected and got[1000].lang_pred in SYLLABLES
    for doc_id in (1001, 1002, 1003):
        assert (got[doc_id].lang_pred, got[doc_id].score, got[doc_id].rejected) == ("und", 0.0, True)
    assert got[None].lang_pred == "bb" and got[None].held_out


def test_labels_of_held_out_rows_are_not_used(spark, rows):
    lied = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    key = lambda r: (r.doc_id, r.lang_pred, r.score)
    assert sorted(map(key, li.predict(frame(spark, rows)).collect())) == sorted(map(key, li.predict(frame(spark, lied)).collect()))


def test_no_language_is_left_out_of_the_counts(spark):
    rng = random.Random(9)
    seen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    docs = [(i, say("aa", rng, 30), "aa") for i in seen[:40]]
    docs += [(i, say("bb", rng, 3000), "bb") for i in seen[40:43]]
    docs += [(i, say("cc", rng, 40), f"c{i}") for i in seen[43:75]] + [(seen[75], "", "aa"), (seen[76], "12", "none")]
    sent = li.fit(frame(spark, docs), sample_chars=200)
    assert {lang for _, _, lang in docs} - {"none"} <= set(sent.value.langs)


def test_nothing_to_learn_from_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "abc", None, 1), (2, None, "x", 2)], "doc_id long, text string, lang string, Language_ long")
    assert {r.lang_pred for r in li.predict(docs).collect()} == {"und"}
    assert li.drop_rejected(docs).count() == 0 and li.predict(docs.limit(0)).count() == 0
    assert li.drop_rejected(docs).columns == docs.columns


def test_probabilities_equal_a_plain_kneser_ney():
    texts = {"x": ["abab ba", "aab"], "y": ["cab bca"]}
    counts, raw = {}, {}
    for lang, own in texts.items():
        sym, _, _ = li.symbols(own)
        g = li.grams(sym)[sym > 0]
        counts[lang] = np.unique(g, return_counts=True)
        raw[lang] = Counter(g.tolist())
    models = li.build_models(counts)

    def plain(lang, gram):
        tables = {li.ORDER: raw[lang]}
        for n in range(li.ORDER - 1, 0, -1):
            tables[n] = Counter(k & ((1 << (12 * n)) - 1) for k in tables[n + 1])
        p = 1 / 4096
        for n in range(1, li.ORDER + 1):
            t, g = tables[n], gram & ((1 << (12 * n)) - 1)
            ones, twos = sum(c == 1 for c in t.values()), sum(c == 2 for c in t.values())
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            same = [c for k, c in t.items() if k >> 12 == g >> 12]
            if same:
                p = max(t.get(g, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * p
        return math.log(p)

    sym, _, _ = li.symbols(["abcab zz a", "b"])
    packed = li.grams(sym)
    got = models.log_probs(packed)
    for row, g in zip(got, packed.tolist()):
        assert row == pytest.approx([plain("x", g), plain("y", g)], rel=1e-4)


def test_texts_do_not_reach_into_each_other():
    sym, starts, letters = li.symbols(["Ab  c!", None, "", "?é"])
    assert [sym[s : s + 4].tolist() for s in starts] == [[0] * 4] * 4
    assert letters.tolist() == [3, 0, 0, 1]
    assert sym.tolist() == [0] * 4 + [99, 100, 1, 101, 1] + [0] * 12 + [235]


def test_a_worker_lets_go_of_earlier_stages_and_scores_little_at_once(rows):
    class Cache:
        pass

    cache = common.held_by_worker("encoder", Cache)
    seen = weakref.ref(cache)
    assert common.held_by_worker("encoder", Cache) is cache
    del cache
    list(li._count_own(iter([pa.RecordBatch.from_arrays([pa.array(["aa"]), pa.array(["kalo"])], ["lang", "text"])])))
    assert seen() is None
    counts = {}
    for lang in SYLLABLES:
        sym, _, _ = li.symbols([t for _, t, own in rows if own == lang])
        counts[lang] = np.unique(li.grams(sym)[sym > 0], return_counts=True)
    models = li.build_models(counts)
    texts = [say("aa", random.Random(i), 400) for i in range(1500)]
    want = models.classify(texts)
    tracemalloc.start()
    (got,) = li._classified(iter([pa.array(texts)]), models)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.equals(want)
    assert most < 60 << 20

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sieveline.llm import token_counts, token_output
from sieveline.llm.encoder import ChunkEncoder, cut_at_added, default_path, library_encoder
from sieveline.llm.token_output import Block, compress, expand

PIECES = ["a", "the", " ", "  ", "\n", "\t ", " \n", "'s", "'", "é", "ß12", "<|endoftext|>", "…", " ", " ", "\x1c", "\x00", "日本", "👍🏽", "!!", " %", "a b"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(default_path())
    return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def mixed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(30))) for _ in range(n)]


def test_stretches_give_the_library_s_ids(library):
    end = "<|endoftext|>"
    texts = mixed(1, 400) + ["", " ", "x " * 5000, " lead", "trail ", end, end * 2, f" {end} ", f"a {end} b", f"{end[:-1]} {end}", f"a\n{end}\n\nb  "]
    plain = [t for t in texts if end not in t]
    assert [list(ids) for ids in library_encoder(default_path())(plain)] == library(plain)
    small = ChunkEncoder(library_encoder(default_path()), cache_entries=50, cut=cut_at_added(default_path()))
    assert library([f"a {end} b"])[0] == [64, 220, 50256, 275]
    for _ in range(2):  # the cache starts anew in between
        flat, sizes = small.encode(texts + [None])
        want = library(texts) + [[]]
        assert sizes.tolist() == [len(w) for w in want] == small.lengths(texts + [None]).tolist()
        assert flat.tolist() == [i for w in want for i in w]


def test_words_told_apart_by_arrow_give_the_library_s_ids(library):
    end = "<|endoftext|>"
    plain = ["Émil said: won't (he) go?!", "x9 12ab\nÉtat,### a\nb c.\nD", "a" * 300 + " b", "", "½ ª º ×÷ ɏɐ", "end.\n", "don't\n'tis", "日本 語"]
    odd = ["a  b", " lead", "trail ", "a \u00a0b", "\n\n a", f"a {end} b", " ", "a \x1cb"]
    texts = [*plain, None, *odd, *mixed(4, 300), *plain]
    path, asked = default_path(), []
    encode = library_encoder(path)

    def counted(words):
        asked.extend(words)
        return encode(words)

    encoder = ChunkEncoder(counted, cut=cut_at_added(path), added=[end])
    flat, sizes = encoder.encode(texts)
    want = library([t or "" for t in texts])
    assert sizes.tolist() == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]
    assert len(asked) == len(set(asked))


def test_pairs_that_cannot_be_frequent_are_not_counted_again(monkeypatch):
    """The last round counts a part of what is left; before, each counted all of it."""
    counted, unique = [], np.unique

    def spy(values, *args, **kwargs):
        if kwargs.get("return_counts"):
            counted.append(len(values))
        return unique(values, *args, **kwargs)

    monkeypatch.setattr(token_output.np, "unique", spy)
    ids = np.minimum(np.random.default_rng(7).zipf(1.3, 60_000), 30_000).astype(np.uint32)
    symbols, rules, _ = compress(ids)
    assert np.array_equal(expand(symbols, rules, int(ids.max()) + 1), ids)
    assert len(counted) > 2 and counted[-1] < len(symbols) / 2


def test_compression_round_trip_and_random_access():
    rng = np.random.default_rng(5)
    for n, kinds in ((0, 3), (1, 3), (2, 1), (999, 1), (5000, 3), (20_000, 300), (3000, 50_000)):
        ids = np.minimum(rng.zipf(1.4, n), kinds).astype(np.uint32)
        symbols, rules, lengths = compress(ids)
        base = int(ids.max()) + 1 if n else 1
        assert np.array_equal(expand(symbols, rules, base), ids)
        for i, size in enumerate(lengths):
            assert len(expand(np.array([base + i]), rules, base)) == size
        cuts = sorted(rng.integers(0, n + 1, 4).tolist())
        sizes = np.diff([0, *cuts, n])
        block = Block(Block.pack([None, 7, 7, 8, 9], sizes, ids))
        assert np.array_equal(block.ids(), ids)
        at = 0
        for k, size in enumerate(sizes.tolist()):
            assert np.array_equal(block.document(k), ids[at : at + size])
            at += size
        for _ in range(20):
            a, b = sorted(rng.integers(0, n + 1, 2).tolist())
            assert np.array_equal(block.slice(a, b), ids[a:b])
    assert len(compress(np.tile(np.arange(50, dtype=np.uint32), 400))[0]) < 2500


def test_compression_goes_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(6)
    copy = rng.integers(0, 40_000, 6000)
    for ids in (np.tile(copy, 30), np.zeros(5000, int), np.minimum(rng.zipf(1.3, 60_000), 30_000)):
        symbols, rules, _ = compress(ids.astype(np.uint32))
        assert np.array_equal(expand(symbols, rules, int(ids.max()) + 1), ids)
        _, counts = np.unique(symbols[:-1] * (1 << 32) + symbols[1:], return_counts=True)
        assert counts.max(initial=0) < token_output.MIN_COUNT
    assert len(compress(np.tile(copy, 30).astype(np.uint32))[0]) < 2500  # four rounds leave 180,000 / 16 at least


def documents(spark):
    rows = [(i, t, i) for i, t in enumerate(mixed(2, 60))] + [(70, None, 1), (71, "", 1), (72, "word " * 30_000, 1), (5, "again", 1), (None, "no id", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(4)


def test_files_hold_all_ids_in_order(spark, library, tmp_path):
    rows, docs = documents(spark)
    token_output.write_ids(docs, f"file://{tmp_path}/ids", block_ids=300)
    got = token_output.read_index(spark, f"file://{tmp_path}/ids").orderBy("start").collect()
    ordered = docs.selectExpr("doc_id", "text", "xxhash64(text) AS tie").orderBy("doc_id", "tie").collect()
    start = 0
    for r, (doc_id, text, _) in zip(got, ordered, strict=True):
        ids = np.array(library([text or ""])[0] + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_histogram_answers_equal_brute_force(spark, library):
    rows, docs = documents(spark)
    sizes = np.array([len(library([t or ""])[0]) for _, t, _ in rows])
    table = token_counts.count_tokens(docs)
    found = {r.n_tokens: r for r in table.collect()}
    assert sorted(found) == sorted(set(sizes.tolist()))
    for n, r in found.items():
        longer = sizes[sizes > n]
        assert (r.n_docs, r.docs_longer, r.tokens_longer) == ((sizes == n).sum(), len(longer), longer.sum())
        assert (r.docs_total, r.tokens_total, r.truncated_total) == (len(sizes), sizes.sum(), np.minimum(sizes, n).sum())
        assert r.quantile == pytest.approx((sizes <= n).mean())
    limits = [0, 1, 5, 1024, 10**6]
    got = {r.limit: r.truncated_total for r in token_counts.truncated_totals(table, limits).collect()}
    assert got == {x: int(np.minimum(sizes, x).sum()) for x in limits}
    median = token_counts.quantiles(table, [0.5, 1.0]).orderBy("share").collect()
    assert [r.n_tokens for r in median] == [int(np.sort(sizes)[(len(sizes) + 1) // 2 - 1]), int(sizes.max())]


def test_empty_tables(spark, tmp_path):
    none = documents(spark)[1].limit(0)
    assert token_counts.count_tokens(none).count() == 0
    token_output.write_ids(none, f"file://{tmp_path}/ids")
    assert token_output.read_index(spark, f"file://{tmp_path}/ids").count() == 0

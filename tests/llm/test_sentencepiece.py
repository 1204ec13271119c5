from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece

from sieveline.llm import sentencepiece_codec as codec

PIECES = ["a", "the ", " ", "  ", "\n", "é", "ß12", "▁", "…", "日本", "👍🏽", "!!", "thand", "stnt", "\x00", "ﬁ", "   x"]


@pytest.fixture(scope="module")
def model():
    return codec.load()


@pytest.fixture(scope="module")
def library():
    """The same vocabulary, its model type set to unigram, in the library."""
    with open(codec.default_path(), "rb") as file:
        return sentencepiece.SentencePieceProcessor(model_proto=file.read() + b"\x12\x02\x18\x01")


def mixed(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(20))) for _ in range(n)]


def test_segmentation_equals_the_library_s_unigram(model, library):
    """Against the best path of the library's lattice (its plain encode() prefers some whole words to better paths)."""
    encoder = codec.PieceEncoder(model, cache_entries=60)
    texts = [t for t in mixed(4, 300) if t and "\x00" not in t] + ["plain words of a sentence, again and again", "x" * 70 + " " + "y" * 40]
    texts = [t[:40] for t in texts]
    for a in range(0, len(texts), 50):
        ids, sizes = encoder.encode(texts[a : a + 50])
        ends = np.cumsum(sizes)
        for text, own in zip(texts[a : a + 50], np.split(ids, ends[:-1])):
            own, (best, second) = own.tolist(), (library.nbest_encode_as_ids(text, 2) * 2)[:2]
            cost = lambda path: sum(model.scores[i] for i in path)
            assert own == best or cost(own) == cost(best) == cost(second) or abs(cost(best)) > 1e8 and cost(own) >= cost(best)


def test_side_by_side_equals_alone_and_brute_force(model):
    rng = random.Random(2)
    words = [codec.MARK + "".join(rng.choices(["th", "an", "é", "日", "x", "\n", "👍"], k=rng.randrange(1, 14))) for _ in range(300)]
    together = model.encode_words(words)
    assert together == [model._alone(w.encode()) for w in words]
    usable = {p.encode() for p, _, t in codec.read_pieces(open(codec.default_path(), "rb").read()) if t in (1, 4)}
    ids = {p: i for i, p in enumerate(model.pieces)}

    def best(data):
        if not data:
            return 0.0
        found, width = [], len(data.decode()[0].encode())
        for k in range(1, len(data) + 1):
            if data[:k] in usable:
                found.append(model.scores[ids[data[:k].decode()]] + best(data[k:]))
        if data[:width] not in usable:
            found.append(model.unknown + best(data[width:]))
        return max(found)

    for word, own in list(zip(words, together))[:40]:
        if len(word.encode()) > 16:
            continue
        total = sum(model.scores[i] for i in own if i not in model.byte_ids)
        lost = sum(model.unknown for c in word if c.encode() not in usable)
        assert total + lost == pytest.approx(best(word.encode()))


def test_trie_holds_exactly_its_keys():
    rng = random.Random(9)
    keys = {bytes(rng.choices(range(256), k=rng.randrange(1, 5))): i for i in range(0, 3000)}
    trie = codec.DoubleArray(keys)

    def get(key):
        state = np.array([0], np.int32)
        for byte in key:
            state = trie.step(state, np.array([byte]))
            if state[0] < 0:
                return -1
        return int(trie.value[state[0]])

    assert all(get(k) == v for k, v in keys.items())
    others = [bytes(rng.choices(range(256), k=3)) for _ in range(2000)]
    assert all(get(k) == keys.get(k, -1) for k in others)


def test_documents_round_trip(spark, model):
    texts = mixed(6, 80) + [None, "", " ", "word " * 30_000, "日" * 20_000, "lead\x00"]
    rows = [(i, t, i) for i, t in enumerate(texts)] + [(None, "again", 1), (0, texts[0], 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Piece_IDs long").repartition(3)
    plain = codec.PieceEncoder(model)
    got = sorted(map(tuple, codec.summary(docs).collect()), key=str)
    want = []
    for doc_id, text, _ in rows:
        ids, _n = plain.encode([text])
        back = (text or "").replace("▁", " ")
        n_bytes = sum(i in model.byte_ids for i in ids.tolist())
        want.append((doc_id, len(ids), n_bytes, zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
    assert got == sorted(want, key=str)
    coded = codec.encode_documents(docs)
    assert coded.columns == ["doc_id", "text", "Piece_IDs", "_piece_ids"]
    sent = codec.ship(docs)
    back = coded.select("text", codec.decode_column(sent, coded["_piece_ids"]).alias("back")).collect()
    assert all(r.back == (r.text or "").replace("▁", " ") for r in back)
    assert codec.summary(docs.limit(0)).count() == 0

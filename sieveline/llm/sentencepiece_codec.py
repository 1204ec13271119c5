"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

A text's spaces become markers and one marker leads; the segmentation of highest total score (the
scores stored in the model file are taken as log scores) is found by Viterbi, where equal totals
go to the longer last piece.  A character that no piece starts with costs more than any piece and
is written as its UTF-8 bytes.  Decoding joins the pieces, turns markers back into spaces and
drops the leading one; it gives the text back unless that holds the marker character itself,
which returns as a space.

Where no piece of the vocabulary holds a marker behind another character, the best path passes
every word start, so words are segmented once per worker and remembered; otherwise texts are
segmented whole.  Words of up to 64 bytes go through the trie side by side in numpy.

A null text encodes like an empty one, to no pieces; repeated rows give equal results, an empty
table gives none, and columns that are not asked for are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import fresh_name, held_by_worker, slices
from sieveline.llm.encoder import ChunkEncoder

MARK = "▁"
#: Piece types of the model file's format.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
#: How much worse than the worst piece an unknown character is.
UNKNOWN_COST = 10.0
#: Bytes of the longest word that is segmented side by side with others.
WIDE = 64


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


def read_pieces(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, type) by id."""
    found = []
    for number, value in _fields(model):
        if number == 1:
            own = dict(_fields(value))
            score = float(np.frombuffer(own.get(2, bytes(4)), "<f4")[0])
            found.append((own.get(1, b"").decode(), score, own.get(3, NORMAL)))
    return found


class DoubleArray:
    """A trie in two arrays: the child of state s by byte c is base[s] + c + 1 where check there is s."""

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key, value in keys.items():
            node = tree
            for byte in key:
                node = node.setdefault(byte, {})
            node[-1] = value
        base, check, value = [-1], [0], [-1]
        used, todo, low = bytearray(b"\1"), [(0, tree)], 1
        while todo:
            state, node = todo.pop()
            value[state] = node.pop(-1, -1)
            if not node:
                continue
            codes = sorted(byte + 1 for byte in node)
            at, tries = low - 1, 0
            while True:  # the first free place where all children fit
                at = used.find(0, at + 1)
                if at < 0 or at + 512 > len(used):
                    more = 512 + len(used) // 2
                    used += bytes(more)
                    for array in (base, check, value):
                        array += [-1] * more
                    at = low - 1 if at < 0 else at - 1
                    continue
                tries += 1
                if at >= codes[0] and not any(used[at - codes[0] + c] for c in codes):
                    break
            if tries > 32:  # what lies below is too full to search again
                low = at
            base[state] = offset = at - codes[0]
            for c in codes:
                used[offset + c] = 1
                check[offset + c] = state
            todo += [(offset + byte + 1, child) for byte, child in node.items()]
        # room so that a look-up from any state stays inside
        self.base, self.check, self.value = (np.array(a + [-1] * 512, np.int32) for a in (base, check, value))

    def step(self, states: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
        """The children, or -1."""
        base = self.base[states]
        to = np.where(base >= 0, base + bytes_ + 1, 0)
        return np.where((to > 0) & (self.check[to] == states), to, -1)


@dataclass
class UnigramModel:
    pieces: list[str]
    scores: np.ndarray
    trie: DoubleArray
    byte_ids: list[int]
    unknown: float
    by_word: bool

    @staticmethod
    def load(model: bytes) -> UnigramModel:
        rows = read_pieces(model)
        scores = np.array([s for _, s, _ in rows], np.float64)
        normal = np.array([t == NORMAL for _, _, t in rows])
        low, high = scores[normal].min(), scores[normal].max()
        for i, (piece, _, kind) in enumerate(rows):
            if kind == USER_DEFINED:  # always worth more than what it consists of
                scores[i] = len(piece.encode()) * high - 0.1
        usable = {p.encode(): i for i, (p, _, t) in enumerate(rows) if t in (NORMAL, USER_DEFINED) and p}
        byte_ids = [-1] * 256
        for i, (piece, _, kind) in enumerate(rows):
            if kind == BYTE:
                byte_ids[int(piece[3:5], 16)] = i
        if min(byte_ids) < 0:
            raise ValueError("the vocabulary lacks byte pieces")
        by_word = not any(MARK in p.lstrip(MARK) for p, _, _ in rows)
        return UnigramModel([p for p, _, _ in rows], scores, DoubleArray(usable), byte_ids, low - UNKNOWN_COST, by_word)

    def stretches(self, text: str) -> list[str]:
        """The marked text, cut where every best path passes."""
        if not text:
            return [""]
        text = text.replace(MARK, " ")
        if not self.by_word:
            return [MARK + text.replace(" ", MARK)]
        out, marks = [], ""
        for part in text.split(" "):
            marks += MARK
            if part:
                out.append(marks + part)
                marks = ""
        return out + [marks] if marks else out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        data = [w.encode("utf-8", "replace") for w in words]
        found: list[list[int] | None] = [None] * len(data)
        sizes = np.array([len(d) for d in data])
        for low, high in ((0, 8), (8, 12), (12, 20), (20, 36), (36, WIDE)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for i in range(0, len(rows), 8192):
                mine = rows[i : i + 8192].tolist()
                for row, ids in zip(mine, self._side_by_side([data[r] for r in mine])):
                    found[row] = ids
        return [self._alone(d) if ids is None else ids for d, ids in zip(data, found)]

    def _alone(self, data: bytes) -> list[int]:
        """Viterbi over one stretch, of any length."""
        n = len(data)
        best, back = [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for start in range(n):
            lead = data[start]
            if 128 <= lead < 192:
                continue
            width = 1 if lead < 128 else 2 if lead < 224 else 3 if lead < 240 else 4
            here, state, single = best[start], 0, False
            for end in range(start, n):
                to = int(base[state]) + data[end] + 1
                if base[state] < 0 or check[to] != state:
                    break
                state = to
                piece = int(value[state])
                if piece >= 0:
                    single |= end + 1 - start == width
                    score = here + float(self.scores[piece])
                    if score > best[end + 1]:
                        best[end + 1], back[end + 1] = score, (start, piece)
            if not single and here + self.unknown > best[start + width]:
                best[start + width], back[start + width] = here + self.unknown, (start, -1)
        ids: list[int] = []
        while n:
            start, piece = back[n]
            ids += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(data[start:n])]
            n = start
        return ids[::-1]

    def _side_by_side(self, data: list[bytes]) -> list[list[int] | None]:
        """Viterbi over short stretches at once; None for those with an unknown character."""
        sizes = np.array([len(d) for d in data])
        n, wide = len(data), int(sizes.max())
        flat = np.zeros((n, wide + 1), np.int32)
        flat[np.arange(wide + 1) < sizes[:, None]] = np.frombuffer(b"".join(data), np.uint8)
        inside = (flat & 0xC0) == 0x80
        width = np.select([flat < 128, flat < 224, flat < 240], [1, 2, 3], 4)
        best = np.full((n, wide + 5), -np.inf)
        best[:, 0] = 0.0
        back, piece_at = np.zeros((n, wide + 5), np.int32), np.full((n, wide + 5), -1, np.int32)
        for start in range(wide):
            rows = np.flatnonzero((sizes > start) & ~inside[:, start])
            single = np.zeros(n, bool)
            live, states = rows, np.zeros(len(rows), np.int32)
            for end in range(start, wide):
                states = self.trie.step(states, flat[live, end])
                going = (states >= 0) & (sizes[live] > end)
                live, states = live[going], states[going]
                if not len(live):
                    break
                pieces = self.trie.value[states]
                whole = pieces >= 0
                at, ids = live[whole], pieces[whole]
                single[at] |= width[at, start] == end + 1 - start
                score = best[at, start] + self.scores[ids]
                better = score > best[at, end + 1]
                at = at[better]
                best[at, end + 1], back[at, end + 1], piece_at[at, end + 1] = score[better], start, ids[better]
            at = rows[~single[rows]]
            to = start + width[at, start]
            better = best[at, start] + self.unknown > best[at, to]
            at, to = at[better], to[better]
            best[at, to], back[at, to], piece_at[at, to] = best[at, start] + self.unknown, start, -1
        steps, position, rows = [], sizes.copy(), np.arange(n)
        unknown = np.zeros(n, bool)
        while len(rows):
            ids = piece_at[rows, position[rows]]
            unknown[rows] |= ids < 0
            column = np.full(n, -2)
            column[rows] = ids
            steps.append(column)
            position[rows] = back[rows, position[rows]]
            rows = rows[position[rows] > 0]
        paths = np.stack(steps[::-1], axis=1).tolist() if steps else [[]] * n
        return [None if lost else [i for i in path if i != -2] for path, lost in zip(paths, unknown.tolist())]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """The text that ids stand for; bytes that are no UTF-8 become replacement characters."""
        own = self._decoding()
        data = b"".join([own[i] for i in ids])
        return data[1:].decode("utf-8", "replace") if data[:1] == b" " else data.decode("utf-8", "replace")

    def _decoding(self) -> list[bytes]:
        table = self.__dict__.get("_bytes")
        if table is None:
            table = [p.replace(MARK, " ").encode() for p in self.pieces]
            for byte, i in enumerate(self.byte_ids):
                table[i] = bytes([byte])
            self.__dict__["_bytes"] = table
        return table


class PieceEncoder(ChunkEncoder):
    """Encodes texts by a model, words remembered."""

    def __init__(self, model: UnigramModel, **options):
        super().__init__(model.encode_words, cut=model.stretches, **options)
        self.model = model


def _worker_encoder(sent) -> PieceEncoder:
    key, model = sent.value
    return held_by_worker((PieceEncoder, key), lambda: PieceEncoder(model))


def load(path: str | None = None) -> UnigramModel:
    with open(path or default_path(), "rb") as file:
        return UnigramModel.load(file.read())


def ship(docs: DataFrame, path: str | None = None):
    """The model as a broadcast; its size is that of the vocabulary file, whatever the documents."""
    with open(path or default_path(), "rb") as file:
        data = file.read()
    key = hashlib.sha256(data).hexdigest()
    return docs.sparkSession.sparkContext.broadcast((key, UnigramModel.load(data)))


def _encoded(sent, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    encoder = _worker_encoder(sent)
    for a, b in slices([(t or "").encode("utf-8", "replace") for t in texts]):
        yield encoder.encode(texts[a:b])


def encode_column(sent, text: Column) -> Column:
    """Piece ids of a text."""

    @arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids.astype(np.int32)))
                for ids, n in _encoded(sent, batch.to_pylist())
            ]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode.asNondeterministic()(text.cast("string"))


def decode_column(sent, ids: Column) -> Column:
    """The text that piece ids stand for; null stays null."""

    @arrow_udf(T.StringType())
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value[1]
        for batch in batches:
            yield pa.array([None if x is None else model.decode(x) for x in batch.to_pylist()], pa.string())

    return decode(ids)


_SUMMARY = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def summary(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_pieces, n_bytes (pieces that stand for one byte), ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), decoded_sha256 and round_trip (decoding gave the text back)."""
    sent = ship(docs, path)

    @arrow_udf(_SUMMARY)
    def summarise(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value[1]
        is_byte = np.zeros(len(model.pieces), bool)
        is_byte[model.byte_ids] = True
        for batch in batches:
            texts = batch.to_pylist()
            rows, at = [], 0
            for ids, n in _encoded(sent, texts):
                ends = np.cumsum(n)
                for a, b in zip((ends - n).tolist(), ends.tolist()):
                    own = ids[a:b]
                    text = model.decode(own.tolist())
                    sha = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
                    crc = zlib.crc32(own.astype("<u4").tobytes())
                    rows.append((b - a, int(is_byte[own].sum()), crc, sha, text == (texts[at] or "")))
                    at += 1
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _SUMMARY.names)

    found = docs.select("doc_id", summarise.asNondeterministic()(F.col("text").cast("string")).alias("r"))
    return found.select("doc_id", "r.*")


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """docs with its pieces: a column piece_ids behind its own (under a longer name where that is taken)."""
    return docs.withColumn(fresh_name(docs, "piece_ids"), encode_column(ship(docs, path), F.col("text")))

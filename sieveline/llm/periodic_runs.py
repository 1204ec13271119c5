"""Periodic runs in word sequences, found online by catchers over dyadic blocks.

A sequence grows word by word (or by many words at once, with the same result).  Every completed
block of m = 1, 2, 4, ... words that starts at a multiple of m has a catcher for periods from m to
2m - 1.  It listens to the m words that follow its block's successor: each appended word moves the
suffix of m words on by one, and when the suffix equals the block, the two are a period apart.  So
each word advances one comparison per block size.  A catch is a square once the words in between
agree as well; squares that overlap in step with their period merge into one run, which goes on
growing with the words appended while it is open.

A run of period q that is at least three periods long holds, within its first 2m - 1 words, a block
whose catcher watches q (m <= q < 2m), and still two periods of agreement from there.  So no
run of EXPONENT >= 3 periods is missed.  A catcher keeps its smallest period only: two periods below
2m at one place have a common divisor below m that a smaller block catches.  A stretch that has
several periods is reported once, with the smallest.

Blocks are compared by hash and confirmed word by word.  Many short texts are one sequence with
a word of its own between them, which no period can cross.

Null and empty texts have no words and no runs, and collapse to the empty text.  Texts of any length
are read whole; a text is one task's work, in memory linear in its length.  Rows stand for
themselves, so repeated rows, ties of doc_id and null ids change nothing, and other columns are not
looked at.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import slices, texts_as_bytes
from sieveline.llm.shingles import mix

#: A run has this many periods and words at least.
EXPONENT, LEAST = 4, 6
#: Up to this block size, a catcher's words are compared column by column.
NARROW = 16

_BASE = 0x9E3779B97F4A7C15 | 1
_RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType(), False),
        T.StructField("runs", T.ArrayType(_RUN, False), False),
        T.StructField("collapsed", T.StringType(), False),
    ]
)
_RUN_ARROW = pa.struct([pa.field(name, pa.int64(), False) for name in ("start", "length", "period")])


def _grown(array: np.ndarray, n: int) -> np.ndarray:
    if n <= len(array):
        return array
    out = np.zeros(max(n, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out


class Catchers:
    """The runs of a sequence of word numbers that is appended to; periods above most are not looked for."""

    def __init__(self, most: int | None = None, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 3:
            raise ValueError("catchers of blocks see runs of three periods or more")
        self.most, self.exponent, self.least = most, exponent, least
        self.n = 0
        self._words = np.zeros(1, np.int64)
        self._sums = np.zeros(1, np.uint64)  # of hash * base^position, before each word
        self._powers = np.ones(1, np.uint64)
        self._next: dict[int, int] = {}  # per block size, the first suffix not yet compared
        self._waiting = np.zeros((2, 0), np.int64)  # catches (start, period) whose second square is not complete
        self._found: dict[int, list[list[int]]] = {}  # per period, [start, end] of its stretches, in order
        self._open: list[tuple[int, list[int]]] = []  # those that reach the last word

    def append(self, words: np.ndarray) -> None:
        """Add words (numbers; equal where the words are equal)."""
        if not len(words):
            return
        n = self.n + len(words)
        self._words, self._sums = _grown(self._words, n), _grown(self._sums, n + 1)
        while len(self._powers) <= n:
            self._powers = np.concatenate([self._powers, self._powers * (self._powers[-1:] * np.uint64(_BASE))])
        self._words[self.n : n] = words
        terms = mix(np.asarray(words).astype(np.uint64), 12) * self._powers[self.n : n]
        self._sums[self.n + 1 : n + 1] = self._sums[self.n] + np.cumsum(terms)
        self.n = n
        still, self._open = self._open, []
        for q, stretch in still:
            self._extend(q, stretch)
        caught, m = [self._waiting], 1
        while 3 * m <= n and (self.most is None or m <= self.most):
            caught.append(self._advance(m))
            m *= 2
        self._judge(np.concatenate(caught, axis=1))

    def _advance(self, m: int) -> np.ndarray:
        """The catches (block start, period) of blocks of m words among the suffixes not yet compared."""
        first, last = self._next.get(m, m), self.n - m + 1  # suffixes by their starts
        if first >= last:
            return np.zeros((2, 0), np.int64)
        self._next[m] = last
        row, end = first // m, -(-last // m)  # suffixes of one catcher are a row
        blocks = self._sums[row * m : end * m : m] - self._sums[(row - 1) * m : (end - 1) * m : m]
        if m <= NARROW:
            hits = []
            for t in range(m):
                starts = self._sums[row * m + t : last : m]
                suffix = self._sums[row * m + t + m : last + m : m] - starts
                at = np.flatnonzero(suffix == blocks[: len(suffix)] * self._powers[m + t])
                hits.append(np.stack([at, np.full(len(at), t)]))
            at, t = np.concatenate(hits, axis=1)
            order = np.lexsort((t, at))
            at, t = at[order], t[order]
        else:
            suffix = np.zeros((end - row) * m, np.uint64)
            suffix[: last - row * m] = self._sums[row * m + m : last + m] - self._sums[row * m : last]
            suffix = suffix.reshape(end - row, m)
            at, t = np.nonzero(suffix == blocks[:, None] * self._powers[m : 2 * m])
        start, period = (at + row - 1) * m, t + m
        keep = (start + period >= first) & (start + period < last)
        if self.most is not None:
            keep &= period <= self.most
        return np.stack([start[keep], period[keep]]).astype(np.int64)

    def _judge(self, caught: np.ndarray) -> None:
        """Catches of which two squares follow each other become runs or merge into them."""
        start, period = caught
        late = start + 3 * period > self.n
        self._waiting = caught[:, late]
        start, period = start[~late], period[~late]
        near = self._sums[start + 2 * period] - self._sums[start]
        far = self._sums[start + 3 * period] - self._sums[start + period]
        squares = near * self._powers[period] == far
        start, period = start[squares], period[squares]
        size = np.int64(1) << np.frexp(period)[1].astype(np.int64) - 1  # of the block: the largest power of two up to the period
        order = np.lexsort((period, start, size))
        start, period, size = start[order], period[order], size[order]
        least = np.ones(len(start), bool)
        least[1:] = (start[1:] != start[:-1]) | (size[1:] != size[:-1])
        start, period = start[least], period[least]
        order = np.lexsort((start, period))
        start, period = start[order], period[order]
        for q in np.unique(period).tolist():
            own = start[np.searchsorted(period, q) : np.searchsorted(period, q, "right")]
            known = self._found.setdefault(q, [])
            i = 0
            while i < len(own):
                at = int(own[i])
                if known and at + 2 * q <= known[-1][1]:  # a square inside a stretch of its period
                    i = int(np.searchsorted(own, known[-1][1] - 2 * q, "right"))
                    continue
                if (self._words[at : at + 2 * q] == self._words[at + q : at + 3 * q]).all():
                    stretch = [self._left(at, q), at + 3 * q]
                    known.append(stretch)
                    self._extend(q, stretch)
                i += 1

    def _left(self, at: int, q: int) -> int:
        """Where the stretch of period q that has the words from at starts."""
        step = 64
        while at:
            low = max(0, at - step)
            unlike = np.flatnonzero(self._words[low:at] != self._words[low + q : at + q])
            if len(unlike):
                return low + int(unlike[-1]) + 1
            at, step = low, 2 * step
        return 0

    def _extend(self, q: int, stretch: list[int]) -> None:
        """Move a stretch's end on over the words there are."""
        end, step = stretch[1], 64
        while end < self.n:
            high = min(self.n, end + step)
            unlike = np.flatnonzero(self._words[end:high] != self._words[end - q : high - q])
            if len(unlike):
                stretch[1] = end + int(unlike[0])
                return
            end, step = high, 2 * step
        stretch[1] = end
        self._open.append((q, stretch))

    def runs(self) -> np.ndarray:
        """start, end, period of the runs in the words so far, by start, then period."""
        long = [
            (a, b, q)
            for q, stretches in self._found.items()
            for a, b in stretches
            if b - a >= max(self.least, self.exponent * q)
        ]
        smallest: dict[tuple[int, int], int] = {}
        for a, b, q in long:
            smallest[a, b] = min(q, smallest.get((a, b), q))
        found = sorted((a, q, b) for (a, b), q in smallest.items())
        return np.array([(a, b, q) for a, q, b in found], np.int64).reshape(-1, 3)


def _numbers(words: list[list[bytes]]) -> np.ndarray:
    """The words of all texts as numbers, a number of its own after each text."""
    flat = [w for own in words for w in own]
    codes = pc.dictionary_encode(pa.array(flat, pa.large_binary())).indices.to_numpy() if flat else np.zeros(0, np.int64)
    counts = np.array([len(own) for own in words], np.int64)
    ends = np.cumsum(counts)
    return np.insert(codes.astype(np.int64), ends, -1 - np.arange(len(words)))


def texts_runs(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The words of every text and its runs (start, end, period)."""
    for a, b in slices(texts):
        words = [(t or b"").split() for t in texts[a:b]]
        longest = max(map(len, words), default=0)
        catchers = Catchers(most=longest // EXPONENT)
        if longest >= LEAST:
            catchers.append(_numbers(words))
        found = catchers.runs()
        starts = np.cumsum([0] + [len(own) + 1 for own in words])
        cuts = np.searchsorted(found[:, 0], starts)
        for i, own in enumerate(words):
            yield own, found[cuts[i] : cuts[i + 1]] - np.array([starts[i], starts[i], 0])


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds beyond its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    out, at = [], 0
    for low, high in sorted((a + q, b) for a, b, q in runs.tolist()):
        out += words[at : max(at, low)]
        at = max(at, high)
    return b" ".join(out + words[at:])


@arrow_udf(RESULT)
def _find(text: pa.Array) -> pa.Array:
    sizes, counts, runs, kept = [], [], [], []
    for words, found in texts_runs(texts_as_bytes(text)):
        sizes.append(len(words))
        counts.append(len(found))
        runs.append(found)
        kept.append(collapsed(words, found))
    flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
    values = pa.StructArray.from_arrays(
        [pa.array(flat[:, 0]), pa.array(flat[:, 1] - flat[:, 0]), pa.array(flat[:, 2])], fields=list(_RUN_ARROW)
    )
    lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), values)
    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), lists, pa.array(kept, pa.binary()).cast(pa.string())], RESULT.names)


def find_runs(docs: DataFrame, text: str | Column = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, runs (start, length, period, by start and period) and the collapsed text."""
    words = F.col(text) if isinstance(text, str) else text
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _find(words.cast("string")).alias("r"))
    return found.select("doc_id", "r.*")


@arrow_udf(T.StringType())
def repeating(doc_id: pa.Array, text: pa.Array) -> pa.Array:
    """The text, but with a repeating tail where crc32 of the decimal doc_id is a multiple of ten.

    With g a tenth of it, the words from a = g % n on repeat those from a to a + p - 1, where
    p = 1 + (n - a) div (3 + g % 8).  Rows without doc_id or words keep their text.
    """
    out = texts_as_bytes(text)
    for i, number in enumerate(doc_id.to_pylist()):
        g, rest = divmod(zlib.crc32(b"%d" % number), 10) if number is not None else (0, 1)
        if rest or not (words := (out[i] or b"").split()):
            continue
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        tail = words[a : a + p] * (1 + (len(words) - a) // p)
        out[i] = b" ".join(words[:a] + tail[: len(words) - a])
    return pa.array(out, pa.binary()).cast(pa.string())


def summary(found: DataFrame) -> DataFrame:
    """One row per row of find_runs: how many runs, the one of most periods, digests of all runs and of the collapsed text."""
    more = (
        "array_sort(runs, (x, y) -> CASE WHEN x.length * y.period <> y.length * x.period "
        "THEN CASE WHEN x.length * y.period > y.length * x.period THEN -1 ELSE 1 END "
        "WHEN x.start <> y.start THEN CASE WHEN x.start < y.start THEN -1 ELSE 1 END "
        "ELSE CASE WHEN x.period < y.period THEN -1 WHEN x.period > y.period THEN 1 ELSE 0 END END)"
    )
    best = F.try_element_at(F.expr(more), F.lit(1))
    lines = F.array_join(F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n'))"), "")
    marked = found.withColumn("best", best)
    return marked.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
        "n_words",
    )

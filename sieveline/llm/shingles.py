"""Hashes of words and word n-grams, in numpy over many texts at once."""

from __future__ import annotations

import numpy as np

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ np.uint64((salt * 0xD6E8FEB86659FD93) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(words: list[list[bytes]], salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word of all texts, in order, and the number of words of each text."""
    counts = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b" ".join([b" ".join(w) for w in words if w]) + b" ", np.uint8)
    if not counts.sum():
        return np.zeros(0, np.uint64), counts
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    # sums of byte * P^position, brought to the word's own start by the inverse power
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1 + salt)) * _powers(len(data), _P))
    own = sums[ends - 1] - np.where(starts > 0, sums[np.maximum(starts - 1, 0)], np.uint64(0))
    back = _powers(len(data), pow(_P, -1, 1 << 64))
    return mix(own * back[starts] + (ends - starts).astype(np.uint64), salt), counts


def ngram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each position; positions too close to the end are left out."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(_P) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out, n)


def shingle_sets(words: list[list[bytes]], n: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its n-word shingles; a shorter text is one shingle of all its words."""
    hashes, counts = word_hashes(words)
    every = ngram_hashes(hashes, n)
    found, at = [], 0
    for count in counts.tolist():
        if count >= n:
            found.append(np.unique(every[at : at + count - n + 1]))
        else:
            found.append(ngram_hashes(hashes[at : at + count], count) if count else np.zeros(0, np.uint64))
        at += count
    return found

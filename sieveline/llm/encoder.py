"""Whole texts to token ids with a byte-level BPE file, each distinct stretch encoded once per worker.

The file's pre-tokeniser never joins a character with a single space behind it that a visible
character follows, so a text may be cut before every such space and its stretches encoded on
their own.  A literal added token in a text, such as <|endoftext|>, gets its own id, as the library does with
add_special_tokens=False; what stands before and behind it is encoded apart.  Words repeat far more often than texts do, which is what the cache of a worker uses.
"""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Callable, Sequence
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sieveline.llm.common import held_by_worker

#: Distinct stretches a worker keeps; beyond them it starts anew.
CACHE_ENTRIES = 1_000_000
#: Words behind those stretches that are kept.
KNOWN_WORDS = 300_000
#: A space that is no safe cut.
_LOOSE = re.compile(r" (?=\s|\Z)")
#: Characters that the splitter keeps apart from a word before them.
_STOPS = frozenset(".,;:!?")
#: What the splitter makes of European letters, digits, stops (no apostrophe) and single line ends; a space leads at most.
_PIECES = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+| ?[!-&(-/:-@\[-`{-~]+|\n")
_SIMPLE = re.compile(r" ?(?:[A-Za-zÀ-ÖØ-öø-ɏ0-9!-&(-/:-@\[-`{-~]+(?:\n(?=\S))?)+")


def _visible_bytes() -> dict[int, int]:
    """The visible character that byte-level vocabularies write for each byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = sorted(set(range(256)) - set(plain))
    return {b: 256 + i for i, b in enumerate(others)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def added_tokens(path: str) -> dict[str, int]:
    """The file's added tokens and their ids.  The library takes them out of a text before anything else."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path).get_added_tokens_decoder()
    if any(token.lstrip or token.rstrip or token.single_word for token in found.values()):
        raise ValueError(f"{path}: added tokens that take spaces or whole words only are not supported")
    return {token.content: number for number, token in found.items()}


def cut_at_added(path: str) -> Callable[[str], list[str]]:
    """`stretches`, but with every added token in the text as a stretch of its own: the leftmost, and of these the longest."""
    added = sorted(added_tokens(path), key=len, reverse=True)
    if not added:
        return stretches
    pattern = re.compile("(" + "|".join(map(re.escape, added)) + ")")

    def cut(text: str) -> list[str]:
        if not any(token in text for token in added):
            return stretches(text)
        out = []
        for part in pattern.split(text):
            if part:
                out += [part] if part in added else stretches(part)
        return out or [""]

    return cut


def library_encoder(path: str) -> Callable[[list[str]], list[Sequence[int]]]:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = added_tokens(path)
    split, model = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model
    if tokenizer.normalizer is not None or not callable(getattr(model, "tokenize", None)):
        return lambda texts: [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    visible = _visible_bytes()
    known: dict[str, tuple[int, ...]] = {}

    def ids_of(word: str) -> tuple[int, ...]:
        """Ids of a lone European word, number or row of stops, with or without a space before it, or of a line end."""
        if (ids := known.get(word)) is None:
            if word.isascii() and word != "\n":
                shown = word.replace(" ", "\u0120")
            else:
                shown = word.encode().decode("latin-1").translate(visible)
            ids = known[word] = tuple([token.id for token in model.tokenize(shown)])
        return ids

    def encode(texts: list[str]) -> list[Sequence[int]]:
        """encode_batch without its bookkeeping of offsets: words that need no splitter once each, the rest split first."""
        if len(known) > KNOWN_WORDS:
            known.clear()
        found = []
        for text in texts:
            if text in added:
                found.append((added[text],))
                continue
            body, stop = (text[:-1], text[-1:]) if text[-1:] in _STOPS else (text, "")
            letters = body[1:] if body[:1] == " " else body
            if letters.isalpha() and (letters.isascii() or max(letters) < "\u0250"):
                found.append(ids_of(body) + ids_of(stop) if stop else ids_of(body))
            elif _SIMPLE.fullmatch(text):
                found.append(tuple(chain.from_iterable(map(ids_of, _PIECES.findall(text)))))
            else:
                found.append([token.id for word, _ in split(text) for token in model.tokenize(word)])
        return found

    return encode


def stretches(text: str) -> list[str]:
    """The text cut before every safe space."""
    head, *rest = text.split(" ")
    if _LOOSE.search(text) is None:
        return [head] + [" " + part for part in rest]
    out = [head]
    for part in rest:
        if part and not part[0].isspace():
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return out


class ChunkEncoder:
    """Encodes texts by their stretches and remembers them."""

    def __init__(
        self,
        encode: Callable[[list[str]], list[Sequence[int]]],
        cache_entries: int = CACHE_ENTRIES,
        cut: Callable[[str], list[str]] = stretches,
        added: Sequence[str] | None = None,
    ):
        """added: the tokens that `cut` keeps apart, where it otherwise cuts before safe spaces; None: it cuts elsewhere."""
        self._encode, self._most, self._cut, self._added = encode, cache_entries, cut, added
        self._clear()

    def _clear(self) -> None:
        self._place: dict[str, int] = {}
        self._ids = np.empty(1 << 16, np.uint32)
        self._start = np.zeros(1 << 14, np.int64)
        self._size = np.zeros(1 << 14, np.int64)
        self._used = 0

    def _learn(self, new: list[str]) -> None:
        found = self._encode(new)
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        first, last = len(self._place), len(self._place) + len(new)
        while last > len(self._start):
            self._start = np.concatenate([self._start, np.zeros_like(self._start)])
            self._size = np.concatenate([self._size, np.zeros_like(self._size)])
        while self._used + len(flat) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        self._ids[self._used : self._used + len(flat)] = flat
        self._size[first:last] = sizes
        self._start[first:last] = self._used + np.cumsum(sizes) - sizes
        self._used += len(flat)
        self._place.update(zip(new, range(first, last)))

    def _places(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        collecting = gc.isenabled()
        gc.disable()  # hundreds of thousands of small lists and strings, none of them cyclic
        try:
            return self._look_up(texts)
        finally:
            if collecting:
                gc.enable()

    def _look_up(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self._place) > self._most:
            self._clear()
        if self._added is None or any(" " in token for token in self._added):
            return self._look_up_parts([self._cut(t or "") for t in texts])
        # words that repeat are told apart by Arrow, so that each is looked up once
        parts = pc.split_pattern(pa.array([t or "" for t in texts], pa.large_string()), " ")
        counts = np.diff(parts.offsets.to_numpy())
        heads = np.cumsum(counts) - counts
        coded = parts.flatten().dictionary_encode()
        index, kinds = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
        apart = np.zeros(len(kinds), bool)
        for token in self._added:
            apart |= pc.match_substring(coded.dictionary, token).to_numpy(zero_copy_only=False)
        lead = pc.utf8_slice_codeunits(coded.dictionary, 0, 1)
        loose = pc.or_(pc.equal(lead, ""), pc.utf8_is_space(lead)).to_numpy(zero_copy_only=False)[index]
        loose[heads] = False  # no space stands before them
        odd = np.logical_or.reduceat(loose | apart[index], heads)  # texts that are not cut before every space
        plain = np.repeat(~odd, counts)
        first = np.zeros(len(index), bool)
        first[heads] = True
        behind = np.zeros(len(kinds), bool)
        behind[index[plain & ~first]] = True
        behind = np.flatnonzero(behind)
        places = np.full(len(kinds), -1)
        places[behind] = self._places_of([" " + kind for kind in kinds[behind].tolist()])
        at = places[index]
        starts = heads[~odd]
        at[starts] = self._places_of(kinds[index[starts]].tolist())
        if not odd.any():
            return at, counts
        other, n = self._look_up_parts([self._cut(texts[i] or "") for i in np.flatnonzero(odd).tolist()])
        counts[odd] = n
        own = np.repeat(odd, counts)
        both = np.empty(len(own), np.int64)
        both[own], both[~own] = other, at[plain]
        return both, counts

    def _look_up_parts(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        return self._places_of(list(chain.from_iterable(parts))), np.array([len(part) for part in parts], np.int64)

    def _places_of(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self._place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list({words[i] for i in missing}))
            at[missing] = [self._place[words[i]] for i in missing]
        return at

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each text has."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        at, counts = self._places(texts)
        sizes = self._size[at]
        ends = np.cumsum(sizes)
        source = np.repeat(self._start[at] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self._ids[source], self._per_text(sizes, counts)

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0, np.int64)
        at, counts = self._places(texts)
        return self._per_text(self._size[at], counts)

    @staticmethod
    def _per_text(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(sizes, np.cumsum(counts) - counts)


def worker_encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for a vocabulary file."""

    def build() -> ChunkEncoder:
        return ChunkEncoder(library_encoder(path), cut=cut_at_added(path), added=tuple(added_tokens(path)))

    return held_by_worker((ChunkEncoder, path), build)

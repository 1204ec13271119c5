"""Language identification by interpolated Kneser-Ney character models, one per language.

A text becomes its lower-cased letters with one space for everything between them.  The models
are of order five and share sorted hash arrays: per order the hashes of all n-grams that any
language has, and beside each the n-gram's interpolated log probability in every language, so one
look-up serves all languages; a second array per order has the back-off weights of contexts.  The
language of lowest cross-entropy per symbol wins.  Rejection is calibrated on labelled texts kept
out of the counts: a text goes where its cross-entropy in the chosen language exceeds both what
texts of its length show by REJECT_SIGMAS standard deviations and what texts of the closest other
language have on average, so a text of several known languages stays.

The models are fitted on a bounded sample: rows chosen by a hash of the id, as many as give
SAMPLE_CHARS characters over all languages together, which also bounds the models' size.

`und` stands for a null text or one without letters (score 0, rejected), and for every text where
there is nothing to learn from.  Rows with a null language or text teach nothing.  Equal
cross-entropies go to the language that sorts first.  Other columns are not looked at, repeated
rows get equal results, and texts of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm.common import fresh_name, let_go, slices

ORDER = 5
#: Characters of sampled training texts, over all languages.
SAMPLE_CHARS = 8_000_000
#: One sampled text in so many calibrates the rejection and is not counted.
CALIBRATE_EVERY = 8
#: Standard deviations above the mean cross-entropy at which a text is rejected.
REJECT_SIGMAS = 8.0
UNKNOWN = "und"
#: Bytes of text that are scored at once: a few dozen bytes of arrays for each.
SCORED_BYTES = 1 << 18

_BITS = 12
_VOCABULARY = 1 << _BITS
_SPREAD = np.uint64(0x9E3779B97F4A7C15)

RESULT_TYPE = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
        T.StructField("entropy", T.DoubleType()),
        T.StructField("n_symbols", T.LongType()),
    ]
)
_RESULT_ARROW = pa.struct(
    [("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()), ("entropy", pa.float64()), ("n_symbols", pa.int64())]
)

_SYMBOLS: np.ndarray | None = None


def _symbol_table() -> np.ndarray:
    """Symbol of each code point: 1 for what is no letter; 0 is the mark before a text."""
    global _SYMBOLS
    if _SYMBOLS is None:
        points = np.arange(0x110000)
        letter = np.array([chr(c).isalpha() for c in range(0x110000)])
        folded = np.where(points < 4000, points, points * 40503 % 4093)
        _SYMBOLS = np.where(letter, 2 + folded, 1).astype(np.uint16)
    return _SYMBOLS


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' symbols, each text behind ORDER - 1 marks; where each begins (marks included); letters per text."""
    marks = ORDER - 1
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\n" * marks + ("\n" * marks).join(lowered)).encode("utf-32-le", "surrogatepass"), "<u4")
    sym = _symbol_table()[points]
    sizes = np.array([len(t) + marks for t in lowered])
    starts = np.cumsum(sizes) - sizes
    for k in range(marks):
        sym[starts + k] = 0
    keep = np.ones(len(sym), bool)
    keep[1:] = ~((sym[1:] == 1) & (sym[:-1] <= 1))  # runs of other characters become one space
    letters = np.add.reduceat((sym > 1).astype(np.int64), starts)
    starts = np.cumsum(np.add.reduceat(keep.astype(np.int64), starts))
    return sym[keep], np.concatenate([[0], starts[:-1]]), letters


def grams(sym: np.ndarray) -> np.ndarray:
    """The ORDER symbols that end at each position, the newest in the low bits; the first few lack a context."""
    packed = np.zeros(len(sym), np.uint64)
    for k in range(ORDER):
        packed[k:] |= sym[: len(sym) - k].astype(np.uint64) << np.uint64(_BITS * k)
    return packed


def _low(packed: np.ndarray, n: int) -> np.ndarray:
    return packed & np.uint64((1 << (_BITS * n)) - 1)


class HashArray:
    """Sorted hashes (the packed symbols times an odd number, so all differ), with a directory by their top bits."""

    def __init__(self, keys: np.ndarray):
        hashes = keys * _SPREAD
        self.order = np.argsort(hashes)
        self.hashes = np.append(hashes[self.order], np.uint64(0))
        self.bits = max(1, int(len(keys)).bit_length() + 1)
        slot = (self.hashes[:-1] >> np.uint64(64 - self.bits)).astype(np.int64)
        self.first = np.searchsorted(slot, np.arange(1 << self.bits)).astype(np.int32)
        self.longest = int(np.bincount(slot).max()) if len(slot) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        hashes = keys * _SPREAD
        at = self.first[(hashes >> np.uint64(64 - self.bits)).astype(np.int64)]
        place = np.where(self.hashes[at] == hashes, at, -1)
        place[at == len(self.hashes) - 1] = -1
        open_ = np.flatnonzero(place < 0)
        for step in range(1, self.longest):
            if not len(open_):
                break
            nxt = np.minimum(at[open_] + step, len(self.hashes) - 1)
            hit = (self.hashes[nxt] == hashes[open_]) & (nxt < len(self.hashes) - 1)
            place[open_[hit]] = nxt[hit]
            open_ = open_[~hit]
        return place


@dataclass
class Models:
    """Log probabilities of all languages, by order."""

    langs: list[str]
    grams: list[HashArray] = field(default_factory=list)  # of orders 1, 2, ...
    log_p: list[np.ndarray] = field(default_factory=list)
    contexts: list[HashArray] = field(default_factory=list)
    log_back: list[np.ndarray] = field(default_factory=list)
    log_new: np.ndarray | None = None  # of a symbol that no language has
    #: Per language: mean, variance between texts and variance of a symbol's surprise; mean of the closest other language.
    calibration: np.ndarray | None = None

    def log_probs(self, packed: np.ndarray) -> np.ndarray:
        """Per position and language."""
        out = np.zeros((len(packed), len(self.langs)), np.float32)
        left = np.arange(len(packed))
        for n in range(ORDER, 0, -1):
            here = _low(packed[left], n)
            place = self.grams[n - 1].find(here)
            seen = place >= 0
            out[left[seen]] += self.log_p[n - 1][place[seen]]
            left, here = left[~seen], here[~seen]
            if not len(left):
                return out
            if n > 1:
                place = self.contexts[n - 1].find(here >> np.uint64(_BITS))
                known = place >= 0
                out[left[known]] += self.log_back[n - 1][place[known]]
        out[left] += self.log_new
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: cross-entropies (nats a symbol) by language, their symbols' variance, symbols, letters."""
        sym, starts, letters = symbols(texts)
        probs = self.log_probs(grams(sym))
        probs[sym == 0] = 0
        n = np.maximum(np.add.reduceat((sym > 0).astype(np.int64), starts), 1)
        sums = np.add.reduceat(probs, starts, dtype=np.float64)
        squares = np.add.reduceat(probs * probs, starts, dtype=np.float64)
        mean = sums / n[:, None]
        return -mean, squares / n[:, None] - mean**2, n, letters

    def classify(self, texts: list[str | None]) -> pa.Array:
        h, _, n, letters = self.entropies(texts)
        best = h.argmin(axis=1)
        low = h[np.arange(len(texts)), best]
        score = 1 / np.exp(low[:, None] - h).sum(axis=1)
        rejected = np.zeros(len(texts), bool)
        if self.calibration is not None:
            mean, between, within, foreign = self.calibration[best].T
            rejected = low > np.maximum(mean + REJECT_SIGMAS * np.sqrt(between + within / n), foreign)
        no = letters == 0
        names = np.array(self.langs, object)[best]
        names[no] = UNKNOWN
        return pa.StructArray.from_arrays(
            [
                pa.array(names.tolist(), pa.string()),
                pa.array(np.where(no, 0.0, score)),
                pa.array(rejected | no),
                pa.array(np.where(no, 0.0, low)),
                pa.array(np.where(no, 0, n)),
            ],
            fields=list(_RESULT_ARROW),
        )


def build_models(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Interpolated Kneser-Ney from counts of ORDER-grams by language."""
    langs = sorted(counts)
    models = Models(langs)
    own = {ORDER: [counts[lang] for lang in langs]}
    for n in range(ORDER - 1, 0, -1):  # lower orders count the distinct symbols seen before an n-gram
        own[n] = [np.unique(_low(keys, n), return_counts=True) for keys, _ in own[n + 1]]
    lower = np.full((1, len(langs)), 1 / _VOCABULARY)
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([k for k, _ in own[n]]))
        contexts, of = np.unique(keys >> np.uint64(_BITS), return_inverse=True)
        below = lower[np.searchsorted(previous, _low(keys, n - 1))] if n > 1 else np.repeat(lower, len(keys), 0)
        p, back = np.empty((len(keys), len(langs))), np.ones((len(contexts), len(langs)))
        for i, (k, c) in enumerate(own[n]):
            full = np.zeros(len(keys))
            full[np.searchsorted(keys, k)] = c
            ones, twos = (c == 1).sum(), (c == 2).sum()
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            total = np.bincount(of, full, len(contexts))
            kinds = np.bincount(of, full > 0, len(contexts))
            seen = total > 0
            back[seen, i] = discount * kinds[seen] / total[seen]
            p[:, i] = np.maximum(full - discount, 0) / np.where(seen, total, 1)[of] + back[of, i] * below[:, i]
        if n == 1:
            models.log_new = np.log(back[0] / _VOCABULARY).astype(np.float32)
        arrays = HashArray(keys), HashArray(contexts)
        models.grams.append(arrays[0])
        models.log_p.append(np.log(p)[arrays[0].order].astype(np.float32))
        models.contexts.append(arrays[1])
        models.log_back.append(np.log(back)[arrays[1].order].astype(np.float32))
        previous, lower = keys, p
    return models


def _count_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sampled rows (lang, text) as counted n-grams."""
    let_go()
    found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            mine = [t for own, t in zip(langs, texts) if own == lang]
            for a, b in slices([t.encode("utf-8", "replace") for t in mine], SCORED_BYTES):
                sym, _, _ = symbols(mine[a:b])
                found.setdefault(lang, []).append(np.unique(grams(sym)[sym > 0], return_counts=True))
    for lang, parts in found.items():
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
        for i in range(0, len(keys), 10_000):
            k = keys[i : i + 10_000].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k), pa.array(n[i : i + 10_000])], ["lang", "gram", "n"])


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a null id is among them."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _classified(batches: Iterator[pa.Array], models: Models) -> Iterator[pa.Array]:
    for batch in batches:
        texts = batch.to_pylist()
        ranges = slices([(t or "").encode("utf-8", "replace") for t in texts], SCORED_BYTES)
        parts = [models.classify(texts[a:b]) for a, b in ranges]
        yield pa.concat_arrays(parts) if parts else pa.array([], _RESULT_ARROW)


def classify_column(sent, text: Column) -> Column:
    """The prediction for a text, by broadcast models (None: nothing was learnt)."""

    @arrow_udf(RESULT_TYPE)
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        let_go()
        yield from _classified(batches, sent.value)

    if sent is None:
        fields = [F.lit(UNKNOWN), F.lit(0.0), F.lit(True), F.lit(0.0), F.lit(0).cast("long")]
        return F.struct(*[value.alias(f.name) for value, f in zip(fields, RESULT_TYPE.fields)])
    return classify.asNondeterministic()(text.cast("string"))


def fit(docs: DataFrame, sample_chars: int = SAMPLE_CHARS):
    """Broadcast models learnt from the labelled rows that are not held out; None if there are none."""
    context = docs.sparkSession.sparkContext
    rows = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    rows = rows.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003))
    least = F.min(F.when(F.col("text").rlike("\\p{L}"), draw))
    found = rows.groupBy("lang").agg(F.sum(F.length("text")), least).collect()  # one row a language
    if not found:
        return None
    sizes = {r[0]: r[1] for r in found}
    each = sample_chars / len(sizes)
    # the rows with letters of smallest draw are always learnt from, so that no language is left out
    floor = F.create_map(*[F.lit(x) for lang, _, at in found for x in (lang, -1 if at is None else at)])[F.col("lang")]
    rate = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, each / max(n, 1)))])
    sample = rows.filter((draw < rate[F.col("lang")] * 1_000_003) | (draw == floor))
    calibrating = (F.pmod(F.xxhash64(F.lit(1), F.col("doc_id")), F.lit(CALIBRATE_EVERY)) == 0) & (draw != floor)
    counted = sample.filter(~calibrating).select("lang", "text").mapInArrow(_count_own, "lang string, gram long, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # about sample_chars rows, or one text a language
    langs = np.array(table["lang"].to_pylist(), object)
    keys, n = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    if not len(keys):
        return None
    counts = {}
    for lang in sorted(set(langs)):
        mine = langs == lang
        order = np.argsort(keys[mine])
        counts[lang] = keys[mine][order], n[mine][order]
    models = build_models(counts)
    models.calibration = _calibrate(context.broadcast(models), sample.filter(calibrating), models.langs)
    return context.broadcast(models)


def _calibrate(sent, rows: DataFrame, langs: list[str]) -> np.ndarray | None:
    def surprise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([t.encode("utf-8", "replace") for t in texts], SCORED_BYTES):
                h, var, n, letters = sent.value.entropies(texts[a:b])
                good = [i for i in range(b - a) if letters[i]]
                for k, lang in enumerate(sent.value.langs):
                    columns = [pa.array(h[good, k]), pa.array(var[good, k]), pa.array(n[good])]
                    names = [pa.array([own[a + i] for i in good], pa.string()), pa.array([lang] * len(good), pa.string())]
                    yield pa.RecordBatch.from_arrays(names + columns, ["own", "model", "h", "var", "n"])

    found = rows.select("lang", "text").mapInArrow(surprise, "own string, model string, h double, var double, n long")
    stats = found.groupBy("own", "model").agg(
        F.sum(F.col("h") * F.col("n")) / F.sum("n"), F.var_pop("h"), F.sum(F.col("var") * F.col("n")) / F.sum("n"), F.count("*")
    )
    by = {(r[0], r[1]): r[2:5] for r in stats.collect() if r[5] >= 8}  # a row per pair of languages
    own = {lang: by[lang, lang] for lang in langs if (lang, lang) in by}
    if not own:
        return None
    loosest = tuple(max(v[i] for v in own.values()) for i in range(3))
    foreign = [min([by[o, lang][0] for o in langs if o != lang and (o, lang) in by], default=0.0) for lang in langs]
    return np.array([[*own.get(lang, loosest), f] for lang, f in zip(langs, foreign)])


def predict(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Per row of docs: doc_id, held_out, lang_pred, score, rejected, entropy, n_symbols."""
    sent = fit(docs, sample_chars)
    found = docs.select("doc_id", classify_column(sent, F.col("text")).alias("r"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "r.*")


def drop_rejected(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """The rows of docs whose language is recognised."""
    name = fresh_name(docs, "language_")
    marked = docs.withColumn(name, classify_column(fit(docs, sample_chars), F.col("text")))
    return marked.filter(~F.col(name)["rejected"]).select(*docs.columns)

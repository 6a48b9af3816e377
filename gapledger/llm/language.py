"""Language ID: one interpolated Kneser-Ney character model per language.

Words are padded with a start and an end mark; a character is predicted from
up to ``order - 1`` before it in its word. Each model's n-grams lie in sorted
arrays of 64-bit hashes beside their discounted probabilities, and contexts
beside their interpolation weights; a lookup is a binary search. The language
with the lowest cross-entropy per character wins; its probability comes from
cross-entropies scaled by a temperature fitted on held-back rows, and a text
whose best cross-entropy lies beyond the calibrated quantile is marked as
rejected. Models are fitted on a bounded sample per language.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordCache, fitted_in_task, mix64, output_columns, slices, sums, with_columns, worker_cache

START, END = "\x02", "\x03"
UNDECIDED = "und"


@dataclass
class CharModel:
    """One language: per order k, sorted hashes of k-grams with their share
    after the discount, and sorted hashes of contexts with what is left for
    the next shorter context. ``unseen`` is the floor below order 1."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    unseen: float

    def log2_probability(self, hashes: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
        """hashes[k], before[k]: of the (k + 1)-gram that ends at each place
        and of its context, zero where the word's start cuts it."""
        p = np.full(len(hashes[0]), self.unseen)
        for (gram, share), (context, rest), h, c in zip(self.grams, self.contexts, hashes, before, strict=True):
            p = np.where(h != 0, _find(gram, share, h, 0.0) + _find(context, rest, c, 1.0) * p, p)
        return np.log2(p)


def _find(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, other: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(asked), other)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, values[at], other)


def gram_hashes(words: list[str], order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per order: hashes of the k-grams that end at each character after the
    start mark (0 if the word is too short for it) and of their contexts; and
    the number of such characters of each word."""
    data = np.frombuffer("".join([START + w + END for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(length) - length
    inner = np.arange(len(data)) - np.repeat(starts, length)  # place in the word
    keep = inner > 0
    grams, contexts = [], []
    for k in range(1, order + 1):
        h, c = np.zeros(len(data), np.uint64), np.zeros(len(data), np.uint64)
        for back in range(k - 1, -1, -1):
            char = np.concatenate([np.zeros(back, np.uint64), data[:len(data) - back]])
            h = h * np.uint64(0x9E3779B97F4A7C15) + char + np.uint64(1)
            if back == 1:
                c = h
        whole = inner >= k - 1
        grams.append(np.where(whole, mix64(h + np.uint64(k)) | np.uint64(1), np.uint64(0))[keep])
        contexts.append((np.where(whole, mix64(c + np.uint64(k)) | np.uint64(1), np.uint64(0)) if k > 1
                         else np.full(len(data), 1, np.uint64))[keep])
    return grams, contexts, length - 1


def fit_char_model(words: list[str], times: np.ndarray, order: int) -> CharModel:
    """Kneser-Ney: the highest order (and k-grams at a word's start, which
    nothing precedes) by counts, lower orders by the number of distinct
    characters before; absolute discounts from counts of one and two."""
    grams, contexts, length = gram_hashes(words, order)
    weight = np.repeat(times, length).astype(np.float64)
    out_g: list = [None] * order
    out_c: list = [None] * order
    longer = None  # (hash of the k-gram without its first character) per distinct (k + 1)-gram
    for k in range(order, 0, -1):
        h, c = grams[k - 1], contexts[k - 1]
        seen = h != 0
        key, first, inverse = np.unique(h[seen], return_index=True, return_inverse=True)
        context = c[seen][first]
        count = np.bincount(inverse, weights=weight[seen], minlength=len(key))
        if longer is not None:
            kinds, n = np.unique(longer, return_counts=True)
            count = np.where(np.isin(key, kinds), _find(kinds, n.astype(float), key, 0.0), count)
        one, two = np.count_nonzero(count == 1), np.count_nonzero(count == 2)
        discount = min(0.95, max(0.1, one / (one + 2 * two))) if one + two else 0.5
        contexts_k, group = np.unique(context, return_inverse=True)
        total = np.bincount(group, weights=count)
        out_g[k - 1] = (key, np.maximum(count - discount, 0) / total[group])
        out_c[k - 1] = (contexts_k, np.bincount(group, weights=np.minimum(count, discount)) / total)
        if k > 1:  # the same place's (k - 1)-gram is this k-gram without its first character
            longer = grams[k - 2][seen][first]
    return CharModel(out_g, out_c, 1.0 / (len(out_g[0][0]) + 1 if len(out_g) else 2))


@dataclass
class Model:
    langs: list[str]
    models: list[CharModel]
    order: int
    temperature: float = 1.0
    limit: float = np.inf  # rejection: bits per character of the best language

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Bits per language, characters, and whether the word has a letter."""
        out = np.zeros((len(words), len(self.langs) + 2))
        if not words:
            return out
        grams, contexts, length = gram_hashes(words, self.order)
        # each distinct longest gram is looked up once; shorter words' grams by all orders
        mixed = grams[-1].copy()
        for k in range(self.order - 2, -1, -1):
            mixed = np.where(mixed == 0, grams[k], mixed)
        _, first, inverse = np.unique(mixed, return_index=True, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(length)])
        g, c = [x[first] for x in grams], [x[first] for x in contexts]
        for i, m in enumerate(self.models):
            out[:, i] = sums(-m.log2_probability(g, c)[inverse], starts)
        out[:, -2] = length
        out[:, -1] = [any(map(str.isalpha, w)) for w in words]
        return out

    def decide(self, total: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the language or -1, probability, bits per character)."""
        n = len(self.langs)
        bits = total[:, :n] / np.maximum(total[:, n], 1)[:, None]
        best = np.argmin(bits, axis=1)
        scaled = np.exp(-np.maximum(bits - bits.min(axis=1, keepdims=True), 0) * self.temperature)
        p = 1 / scaled.sum(axis=1)
        blank = total[:, -1] == 0
        return np.where(blank, -1, best), np.where(blank, 0.0, p), np.where(blank, np.nan, bits.min(axis=1))


def split(text: str) -> list[str]:
    return text.lower().split()


def fit(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = 600,
        order: int = 4, reject: float = 0.001) -> Model | None:
    """Fits on at most ``per_language`` documents of each language of ``docs``
    (training rows only), those with the smallest hashes of ``doc``, one text
    (the smallest) of those that repeat an id; a quarter
    of them is held back for the temperature and the rejection limit. Rows
    whose text or language is null are left out; None if none is left."""
    ids = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(doc).alias("_doc"), F.col(lang).alias("_lang")).distinct().withColumn("_hash", F.xxhash64("_doc"))
    for spread in (["_lang", F.pmod("_hash", F.lit(64))], ["_lang"]):  # a language may hold most rows: first the smallest of each share
        ids = ids.withColumn("_rank", F.row_number().over(Window.partitionBy(*spread).orderBy("_hash", "_doc"))).where(F.col("_rank") <= per_language)
    rows = (docs.select(F.col(doc).alias("_doc"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
            .join(F.broadcast(ids.select("_doc", "_lang", "_rank")), ["_doc", "_lang"])  # bounded per language
            .groupBy("_doc", "_lang", "_rank").agg(F.min("_text").alias("_text")).where(F.col("_text").isNotNull()))

    def run(table) -> Model:
        table = table.sort_by([(c, "ascending") for c in ("_lang", "_rank", "_text")])
        return fit_models(*(table.column(c).to_pylist() for c in ("_lang", "_rank", "_text")), order, reject)

    return fitted_in_task(rows, run)


def fit_models(langs_of: list[str], ranks: list[int], texts: list[str], order: int, reject: float) -> Model:
    """One character model per language from three of four texts; temperature
    and rejection limit from the others (every fourth rank)."""
    langs = sorted(set(langs_of))
    held = [i for i, r in enumerate(ranks) if r % 4 == 0]
    models = []
    for name in langs:
        counts: dict[str, int] = {}
        for i, text in enumerate(texts):
            if langs_of[i] == name and (ranks[i] % 4 or len(held) < 2 * len(langs)):
                for w in split(text):
                    counts[w] = counts.get(w, 0) + 1
        counts = counts or {name: 1}
        models.append(fit_char_model(list(counts), np.array(list(counts.values())), order))
    model = Model(langs, models, order)
    total = np.array([model.word_rows(split(texts[i])).sum(axis=0) for i in held]).reshape(len(held), len(langs) + 2)
    truth = np.array([langs.index(langs_of[i]) for i in held])
    known = total[:, -1] > 0 if len(held) else np.zeros(0, bool)
    if known.any():
        bits = total[known, :len(langs)] / total[known, -2][:, None]
        grid = np.geomspace(0.25, 64, 33)
        loss = [np.mean(np.log(np.exp(-(bits - bits.min(1, keepdims=True)) * t).sum(1)) + t * (
            bits[np.arange(len(bits)), truth[known]] - bits.min(1))) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        model.limit = float(np.quantile(bits.min(1), 1 - reject))
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` without the text column, with lang_pred, score (0 to 1),
    bits_per_char and rejected. A null text or one without a letter is ``und``
    with score 0; with no model every text is."""
    made = {"lang_pred": "string", "score": "double", "bits_per_char": "double", "rejected": "boolean"}
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches):
        m = shared.value
        cache = worker_cache(name, lambda: WordCache(m.word_rows if m else lambda ws: np.zeros((len(ws), 2))))
        names = np.array([*(m.langs if m else []), UNDECIDED], object)
        for batch in batches:
            for part, found in slices(batch, text):
                ids, starts = cache.rows_of([split(t.decode("utf-8", "replace")) for t in found])
                rows = cache.rows[ids] if len(ids) else np.zeros((0, (len(m.langs) if m else 0) + 2))
                if m:
                    best, p, bits = m.decide(sums(rows, starts))
                else:
                    best, p, bits = np.full(len(found), -1), np.zeros(len(found)), np.full(len(found), np.nan)
                yield with_columns(part, {"lang_pred": names[best], "score": p, "bits_per_char": bits,
                                          "rejected": (best < 0) | (bits > (m.limit if m else np.inf))}, (text,))

    return docs.mapInArrow(run, output_columns(docs, made, (text,)))

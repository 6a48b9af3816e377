"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (hashed to a fixed table) and
itself; misspellings never seen share most n-grams with the word they bend.
A window of two words is the average of its subwords' embeddings, put
through a linear softmax; embeddings and softmax are trained jointly, in
numpy. A document is as toxic as its most toxic window, which keeps a short
insult in a long text visible; a logistic scale turns that into a probability.

Training alternates between choosing each document's worst window and a step
on the chosen windows, after a start on short documents taken whole. The
sample is bounded; every text is scored whole, in tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (Vocabulary, WordCache, fit_logistic, fitted_in_task, mix64, output_columns, sigmoid, slices, smallest, tidy,
                     with_columns, word_bytes, worker_cache)

#: Punctuation at the ends of a word that is not part of it.
EDGES = b".,;:!?\"'()[]{}<>|*#$%&-_"


@dataclass(frozen=True)
class Shape:
    buckets: int = 1 << 18
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    window: int = 2
    least: int = 16  # subwords that an average is taken over at least


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled rows that are fitted on."""

    toxic: int = 2000
    clean: int = 3000


def normal(words: list[bytes]) -> list[bytes]:
    return [w.strip(EDGES) or w for w in words]


def subwords(words: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each subword, first subword of each word and the end)."""
    parts = [_subwords(words[at:at + 30_000], shape) for at in range(0, len(words), 30_000)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    return (np.concatenate([k for k, _ in parts]),
            np.concatenate([[0], np.cumsum(np.concatenate([np.diff(s) for _, s in parts]))]))


def _subwords(words: list[bytes], shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    data, length = word_bytes(normal(words), b"<", b">")
    starts = np.cumsum(length) - length
    word_of = np.repeat(np.arange(len(length)), length)
    left = (starts + length)[word_of] - np.arange(len(data))  # bytes from here to the word's end
    hashed = np.zeros(len(data), np.uint64)
    owners, keys = [np.arange(len(length))], []
    padded = np.append(data, np.zeros(shape.longest, np.uint8)).astype(np.uint64)
    for n in range(1, shape.longest + 1):
        hashed = hashed * np.uint64(257) + padded[n - 1:n - 1 + len(data)] + np.uint64(1)
        if n >= shape.shortest:
            at = np.flatnonzero(left >= n)
            owners.append(word_of[at])
            keys.append(mix64(hashed[at] + np.uint64(n << 56)))
    placed = mix64(padded[:len(data)] * np.uint64(0x9E3779B97F4A7C15)
                   + (np.arange(len(data)) - starts[word_of]).astype(np.uint64))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(placed, out=total[1:])
    whole = mix64(total[starts + length] - total[starts])
    owner = np.concatenate(owners)
    key = np.concatenate([whole, *keys]) % np.uint64(shape.buckets)
    order = np.argsort(owner, kind="stable")
    return key[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(length)))])


def worst_windows(score: np.ndarray, size: np.ndarray, words: np.ndarray, starts: np.ndarray, shape: Shape
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(mean score, first word) of each document's worst window (a shorter
    document is one window); an empty document has mean 0. A word that a
    window repeats counts once, and a window of few subwords is filled up with
    neutral ones: one odd word alone is not an average."""
    n = np.diff(starts)
    doc = np.repeat(np.arange(len(n)), n)
    score = score.copy()
    for back in range(1, shape.window):
        score[back:][(words[back:] == words[:-back]) & (doc[back:] == doc[:-back])] = 0
    total = np.concatenate([[0.0], np.cumsum(score)])
    count = np.concatenate([[0.0], np.cumsum(size)])
    first = np.arange(len(score))
    to = np.minimum(first + shape.window, starts[1:][doc])
    whole = (to - first == shape.window) | (first == starts[:-1][doc])
    mean = np.where(whole, (total[to] - total[first]) / np.maximum(count[to] - count[first], shape.least), -np.inf)
    best, at = np.zeros(len(n)), np.zeros(len(n), np.int64)
    full = np.flatnonzero(n)
    if len(full):
        best[full] = np.maximum.reduceat(mean, starts[:-1][full])
        hit = np.flatnonzero(mean == np.repeat(best, n))
        at[doc[hit[::-1]]] = hit[::-1]
    return best, at


@dataclass
class Model:
    shape: Shape
    embeddings: np.ndarray  # buckets x dim
    weights: np.ndarray  # dim: of the toxic class less the other's
    bias: float
    slope: np.ndarray  # of the worst window's mean, of log words, and 1

    def word_rows(self, words: list[bytes]) -> np.ndarray:
        """(sum of subword scores, number of subwords) of each word."""
        key, starts = subwords(words, self.shape)
        return _word_rows(self.embeddings @ self.weights, key, starts)

    def score(self, best: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return sigmoid(np.column_stack([best + self.bias, np.log1p(n_words), np.ones(len(best))]) @ self.slope)


def _word_rows(values: np.ndarray, key: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values[key], dtype=np.float64)])
    return np.column_stack([total[starts[1:]] - total[starts[:-1]], np.diff(starts)])


def train(documents: Iterable[list[bytes]], toxic: np.ndarray, shape: Shape = Shape(), warm: int = 6, rounds: int = 12,
          rate: float = 0.05, seed: int = 11) -> Model:
    """Joint training of embeddings and softmax by Adagrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    vocab = Vocabulary()
    ids = [vocab.ids(d) for d in documents]  # one document's words at a time
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    n = np.array([len(i) for i in ids], np.int64)
    starts = np.concatenate([[0], np.cumsum(n)])
    key, sub_starts = subwords(list(vocab), shape)
    sub_n = np.diff(sub_starts)
    emb = rng.normal(0, 0.1, (shape.buckets, shape.dim)).astype(np.float32)
    w, b = rng.normal(0, 0.5, shape.dim).astype(np.float32), 0.0
    g_emb, g_w, g_b = np.full(shape.buckets, 1e-6, np.float32), np.full(shape.dim, 1e-6, np.float32), 1e-6

    def step(first: np.ndarray, last: np.ndarray, y: np.ndarray) -> None:
        nonlocal b, w, g_w, g_b
        for part in np.array_split(rng.permutation(len(first)), max(1, len(first) // 128)):
            width = last[part] - first[part]
            words = flat[np.repeat(first[part] - np.cumsum(width) + width, width) + np.arange(width.sum())]
            owner = np.repeat(np.arange(len(part)), width)
            size = sub_n[words]
            idx = key[np.repeat(sub_starts[words] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            own = np.repeat(owner, size)
            bag = np.maximum(np.bincount(own, minlength=len(part)), shape.least)
            cuts = np.searchsorted(own, np.arange(len(part)))
            mean = np.add.reduceat(emb[idx], cuts, axis=0) / bag[:, None]
            error = (sigmoid(mean @ w + b) - y[part]).astype(np.float32)
            grad_w, grad_b = mean.T @ error / len(part), float(error.mean())
            per_sub = (error / bag)[own]
            g = np.bincount(idx, weights=per_sub, minlength=shape.buckets).astype(np.float32)
            hit = np.flatnonzero(g)
            g_emb[hit] += g[hit] ** 2 * float(w @ w) / shape.dim
            emb[hit] -= rate * (g[hit] / np.sqrt(g_emb[hit]))[:, None] * w
            g_w += grad_w ** 2
            w = w - rate * grad_w / np.sqrt(g_w)
            g_b += grad_b ** 2
            b -= rate * grad_b / np.sqrt(g_b)

    def windows() -> tuple[np.ndarray, np.ndarray]:
        rows = _word_rows(emb @ w, key, sub_starts)
        return worst_windows(rows[flat, 0], rows[flat, 1], flat, starts, shape)

    y = toxic.astype(np.float32)
    short = np.flatnonzero((n > 0) & (n <= 12 * shape.window))
    for _ in range(warm if len(set(y[short])) > 1 else 0):
        step(starts[short], starts[short + 1], y[short])
    full = np.flatnonzero(n > 0)
    for _ in range(rounds if len(full) else 0):
        _, at = windows()
        free = starts[:-1] + (rng.random(len(n)) * np.maximum(1, n - shape.window + 1)).astype(np.int64)
        clean = full[y[full] == 0]
        first = np.concatenate([at[full], free[clean]])
        doc = np.concatenate([full, clean])
        step(first, np.minimum(first + shape.window, starts[1:][doc]), y[doc])
    best, _ = windows()
    slope = fit_logistic(np.column_stack([best + b, np.log1p(n)]), y) if len(set(y)) > 1 else np.array([1.0, 0.0, 0.0])
    return Model(shape, emb, w, float(b), slope)


def fit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: Sample = Sample(), shape: Shape = Shape()) -> Model | None:
    """Fits on the labelled rows among ``docs`` (training rows only); null
    labels are left out; of several labels of a document the largest counts, of
    rows that repeat an id the smallest text. None if no labelled document is
    found."""
    known = (labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull()).groupBy(doc)
             .agg(F.max(label).alias("label")))
    chosen = smallest(known.where("label = 1"), doc, sample.toxic).unionByName(
        smallest(known.where("label = 0"), doc, sample.clean)).withColumnRenamed(doc, "_doc")
    rows = (docs.select(F.col(doc).alias("_doc"), F.coalesce(text, F.lit("")).cast("binary").alias("_text"))
            .join(F.broadcast(chosen), "_doc")  # bounded by sample
            .groupBy("_doc", "label").agg(F.min("_text").alias("_text")))

    def run(table: pa.Table) -> Model:
        table = table.sort_by([("_doc", "ascending"), ("_text", "ascending")])
        return train((t.as_py().lower().split() for t in table.column("_text")),
                     table.column("label").to_numpy() == 1, shape)

    return fitted_in_task(rows, run)


def _scored(batches, shared, name: str, text: str):
    """(rows, score of each) in slices of bounded size."""
    m = shared.value
    cache = worker_cache(name, lambda: WordCache(m.word_rows if m else lambda ws: np.zeros((len(ws), 2))))
    for batch in batches:
        for part, found in slices(batch, text):
            ids, starts = cache.rows_of([t.lower().split() for t in found])
            rows = cache.rows[ids] if len(ids) else np.zeros((0, 2))
            best, _ = worst_windows(rows[:, 0], rows[:, 1], ids, starts, m.shape if m else Shape())
            yield part, m.score(best, np.diff(starts)) if m else np.zeros(len(best))


def score(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the text column, with score and predicted. Null and
    empty texts are scored as a window without words; with no model every score
    is 0. Rows stay as they are, repeated ones too."""
    made, name = {"score": "double", "predicted": "int"}, uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, s in _scored(batches, shared, name, text):
            yield with_columns(part, {"score": s, "predicted": (s >= threshold).astype(np.int32)}, (text,))

    return docs.mapInArrow(tidy(run), output_columns(docs, made, (text,)))


def accepted(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``score`` would predict as 0, as they are."""
    name, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for part, s in _scored(batches, shared, name, text):
            yield part.filter(pa.array(s < threshold))

    return docs.mapInArrow(tidy(run), columns)

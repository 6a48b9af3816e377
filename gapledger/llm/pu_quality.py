"""Quality classifier by positive-unlabelled learning.

A small network over text statistics is trained on trusted positives and
unlabelled web text, without negatives, by the non-negative unbiased risk
``pi R+(f) + max(0, Ru-(f) - pi R+-(f))`` with an estimated class prior pi;
where the bracket turns negative, its gradient is stepped back. A logistic
scale, fitted on labelled training rows, makes the output a probability.

Statistics of whole texts are computed in tasks, in numpy. The sample that is
fitted on is bounded (``Sample``); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordCache, fit_logistic, fitted_in_task, output_columns, sigmoid, slices, smallest, sums, tidy, with_columns, worker_cache

FEATURES = 20


@dataclass(frozen=True)
class Sample:
    """Bounds of the rows that are fitted on."""

    positives: int = 4000
    unlabelled: int = 8000
    calibration: int = 4000


def word_flags(words: list[bytes]) -> np.ndarray:
    """Per word: length, has capitals only, has a symbol, is one punctuation
    mark, has a digit, capital first, capital after the first, ends a sentence,
    exclamations, is not ASCII, is longer than 25 bytes."""
    out = np.zeros((len(words), 11), np.float32)
    if not words:
        return out
    data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(length + 1)
    starts = ends - length - 1

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return total[ends - 1] - total[starts]

    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    symbol = np.isin(data, np.frombuffer(b"#*$%&|<>=_{}[]~^\\/@+", np.uint8))
    n_upper, n_lower = count(upper), count(lower)
    first, last = data[starts], data[ends - 2]
    out[:, 0] = length
    out[:, 1] = (n_upper > 1) & (n_lower == 0)
    out[:, 2] = count(symbol) > 0
    out[:, 3] = (length == 1) & ~(upper | lower | (data >= 128) | ((data >= 48) & (data <= 57)))[starts]
    out[:, 4] = count((data >= 48) & (data <= 57)) > 0
    out[:, 5] = (first >= 65) & (first <= 90)
    out[:, 6] = n_upper > out[:, 5]
    out[:, 7] = np.isin(last, np.frombuffer(b".!?", np.uint8))
    out[:, 8] = count(data == 33)
    out[:, 9] = count(data >= 128) > 0
    out[:, 10] = length > 25
    return out


def features(texts: list[bytes], cache: WordCache) -> np.ndarray:
    """(documents, FEATURES): means of the word flags, then length, variety and
    repetition of words, pairs and lines. An empty text has zeros."""
    words = [t.split() for t in texts]
    ids, starts = cache.rows_of(words)
    n = np.diff(starts)
    out = np.zeros((len(texts), FEATURES))
    means = sums(cache.rows[ids] if len(ids) else np.zeros((0, 11)), starts) / np.maximum(n, 1)[:, None]
    out[:, :11] = means
    for i, t in enumerate(texts):
        own = ids[starts[i]:starts[i + 1]]
        if not len(own):
            continue
        ordered = np.sort(own)
        new = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        runs = np.diff(np.append(new, len(own)))
        out[i, 11] = np.log1p(len(own))
        out[i, 12] = len(new) / len(own)
        out[i, 13] = runs.max() / len(own)
        if len(own) > 1:
            out[i, 14] = np.mean(own[1:] == own[:-1])
            pairs = np.sort(own[1:] * 1_000_003 + own[:-1])
            out[i, 15] = np.count_nonzero(pairs[1:] == pairs[:-1]) / len(pairs)
        lines = t.split(b"\n")
        out[i, 16] = 1 - len(set(lines)) / len(lines)
        out[i, 17] = len(lines) / len(own)
        out[i, 18] = len(own) < 10
        out[i, 19] = len(t) / len(own) / 10
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    slope: np.ndarray  # of the output and 1

    def output(self, x: np.ndarray) -> np.ndarray:
        return forward(self.layers, np.clip((x - self.mean) / self.scale, -6, 6))[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope[0] * self.output(x) + self.slope[1])


def forward(layers: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    hidden = np.tanh(x @ w1 + b1)
    return hidden, hidden @ w2 + b2[0]


def gradients(layers: list[np.ndarray], x: np.ndarray, hidden: np.ndarray, by_output: np.ndarray) -> list[np.ndarray]:
    back = by_output[:, None] * layers[2] * (1 - hidden ** 2)
    return [x.T @ back, back.sum(0), hidden.T @ by_output, np.array([by_output.sum()])]


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 600,
             rate: float = 0.02, seed: int = 7) -> list[np.ndarray]:
    """Weights that minimise the non-negative risk with the logistic loss, by Adam."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 0.3, (positive.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 0.3, hidden), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, steps + 1):
        hp, fp = forward(layers, positive)
        hu, fu = forward(layers, unlabelled)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        risk = gradients(layers, positive, hp, -prior * sigmoid(-fp) / len(fp))
        minus = [a - b for a, b in zip(gradients(layers, unlabelled, hu, sigmoid(fu) / len(fu)),
                                       gradients(layers, positive, hp, prior * sigmoid(fp) / len(fp)))]
        grads = [a + b for a, b in zip(risk, minus)] if negative >= 0 else [-b for b in minus]
        for i, g in enumerate(grads):
            g = g + 1e-4 * layers[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            layers[i] = layers[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return layers


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.2) -> float:
    """Share of positives among the unlabelled rows, from these two samples
    alone: a logistic model tells them apart, and of the rows beyond a score the
    unlabelled sample holds at least the prior times what the positive one
    holds. The smallest such ratio, over scores that a share ``least`` of the
    positives or more are beyond, bounds the prior, and meets it where hardly
    any negative scores so high. Each half of the rows is rated by a model of
    the other half."""
    scores: dict[str, list] = {"p": [], "u": []}
    for half in (0, 1):
        p, u = positive[1 - half::2], unlabelled[1 - half::2]
        if not len(p) or not len(u):
            return float(np.clip(len(positive) / max(1, len(unlabelled)), 0.01, 0.99))
        w = fit_logistic(np.concatenate([p, u]), np.repeat([1.0, 0.0], [len(p), len(u)]))
        for name, rows in (("p", positive[half::2]), ("u", unlabelled[half::2])):
            scores[name].append(rows @ w[:-1] + w[-1])
    p, u = (np.sort(np.concatenate(scores[k])) for k in "pu")
    cuts = p[np.unique((np.linspace(0, 1 - least, 41) * (len(p) - 1)).astype(int))]
    beyond = [1 - np.searchsorted(s, cuts) / len(s) for s in (p, u)]
    noise = np.sqrt(beyond[1] * (1 - beyond[1]) / len(u)) + np.sqrt(beyond[0] * (1 - beyond[0]) / len(p))
    return float(np.clip(((beyond[1] + noise) / beyond[0]).min(), 0.01, 0.99))


def _feature_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    cache = worker_cache("pu_quality", lambda: WordCache(word_flags))
    for batch in batches:
        for part, found in slices(batch, text):
            yield part, features(found, cache)


def fit(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", label: str = "quality",
        sample: Sample = Sample()) -> Model | None:
    """Fits on ``docs`` (training rows only, labelled or not) and ``labels``
    (doc, label 0 or 1; nulls are left out; of several labels of a document the
    largest counts, of rows that repeat an id the smallest text). None if there
    is no positive or no document."""
    known = (labels.where(F.col(doc).isNotNull() & F.col(label).isNotNull()).groupBy(doc)
             .agg(F.max(label).alias("label")))
    positives = smallest(known.where("label = 1"), doc, sample.positives).withColumn("kind", F.lit("p"))
    rated = smallest(known, doc, sample.calibration).withColumn("kind", F.lit("c"))
    others = smallest(docs.select(doc).where(F.col(doc).isNotNull()), doc, sample.unlabelled).select(
        doc, F.lit(None).cast("int").alias("label"), F.lit("u").alias("kind"))
    chosen = (positives.unionByName(rated).unionByName(others).groupBy(doc)
              .agg(F.max("label").alias("label"), F.collect_set("kind").alias("kinds")))
    rows = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).join(
        F.broadcast(chosen.withColumnRenamed(doc, "_doc")), "_doc")  # bounded by sample
    rows = rows.groupBy("_doc").agg(F.min("_text").alias("_text"), F.first("label").alias("label"), F.first("kinds").alias("kinds"))

    def run(batches):
        for part, x in _feature_batches(batches, "_text"):
            yield pa.RecordBatch.from_arrays(
                [part.column("_doc").cast(pa.string()), part.column("label").cast(pa.int32()), part.column("kinds"),
                 pa.array(list(x), pa.list_(pa.float64()))], names=["doc", "label", "kinds", "x"])

    made = rows.mapInArrow(tidy(run), "doc string, label int, kinds array<string>, x array<double>")
    return fitted_in_task(made, train)


def train(table: pa.Table) -> Model | None:
    """The model of a table (doc, label, kinds, x); its rows may come in any order."""
    table = table.sort_by("doc")
    kinds, y = table.column("kinds").to_pylist(), np.array([-1 if v is None else v for v in table.column("label").to_pylist()])
    x = np.array(table.column("x").to_pylist(), np.float64).reshape(table.num_rows, FEATURES)
    kind = {k: np.array([k in r for r in kinds], bool) for k in "pcu"}
    if not kind["p"].any() or not kind["u"].any():
        return None
    mean, scale = x[kind["u"]].mean(0), x[kind["u"]].std(0) + 1e-6
    z = np.clip((x - mean) / scale, -6, 6)
    layers = fit_nnpu(z[kind["p"]], z[kind["u"]], class_prior(z[kind["p"]], z[kind["u"]]))
    rated_rows = kind["c"] & (y >= 0)
    out = forward(layers, z)[1]
    slope = fit_logistic(out[rated_rows, None], (y[rated_rows] == 1).astype(float)) if len(set(y[rated_rows])) > 1 else np.array([1.0, 0.0])
    return Model(mean, scale, layers, slope)


def score(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the text column, with score and predicted. Null and
    empty texts are scored as texts without words; with no model every score is
    0.5. Rows stay as they are, repeated ones too."""
    made = {"score": "double", "predicted": "int"}

    def run(batches):
        for part, x in _feature_batches(batches, text):
            s = model.score(x) if model else np.full(len(x), 0.5)
            yield with_columns(part, {"score": s, "predicted": (s >= threshold).astype(np.int32)}, (text,))

    return docs.mapInArrow(tidy(run), output_columns(docs, made, (text,)))


def accepted(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that ``score`` would predict as 1, as they are;
    with no model all of them."""
    if model is None:
        return docs
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches):
        for part, x in _feature_batches(batches, text):
            yield part.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(tidy(run), columns)

import helpers
import numpy as np
import pytest

from gapledger.llm import pu_quality, toxicity
from gapledger.llm.queries import op4_toxicity, op6_pu_quality

SF = "/root/testdata/sf0.01"


def labels(spark, column):
    return {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


@pytest.mark.parametrize("query, column, mod, rest, threshold, least", [
    (op4_toxicity, "toxic", 5, 0, 0.5, 0.9), (op6_pu_quality, "quality", 4, 2, 0.7, 0.9)])
def test_held_out_accuracy(spark, query, column, mod, rest, threshold, least):
    known = labels(spark, column)
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (helpers.crc(r.doc_id) % mod == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold)
    right = [r.predicted == known[r.doc_id] for r in rows if r.held_out and r.doc_id in known]
    assert len(right) > 40 and np.mean(right) >= least


@pytest.mark.parametrize("module, column", [(toxicity, "toxic"), (pu_quality, "quality")])
def test_odd_inputs(spark, odd, empty, module, column):
    rated = spark.createDataFrame([(5, 1), (6, 1), (8, 0), (4, 0), (5, None), (None, 1), (99, 1)], f"doc_id bigint, {column} int")
    model = module.fit(odd, rated)
    for m in (model, None):
        got = module.score(odd.withColumnRenamed("lang", "score"), m).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
        assert module.score(empty, m).collect() == [] and module.accepted(empty, m).collect() == []
        kept = module.accepted(odd, m)
        assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert module.fit(empty, rated) is None
    assert module.fit(odd, rated.limit(0)) is None


def test_misspelled_insults_share_subwords():
    rng = np.random.default_rng(5)
    vocab = ["".join(rng.choice(list("abcdefghijklmnop"), 5)).encode() for _ in range(400)]
    texts = [[vocab[i] for i in rng.integers(0, 400, rng.integers(4, 60))] for _ in range(400)]
    bad = np.arange(400) % 4 == 0
    for i in np.flatnonzero(bad):
        texts[i].insert(int(rng.integers(0, len(texts[i]))), [b"worthless", b"disgusting"][i % 8 // 4])
    model = toxicity.train(texts, bad, toxicity.Shape(buckets=1 << 14))

    def score(words):
        rows = model.word_rows(words)
        best, _ = toxicity.worst_windows(rows[:, 0], rows[:, 1], np.arange(len(words)), np.array([0, len(words)]), model.shape)
        return model.score(best, np.array([len(words)]))[0]

    clean = [vocab[i] for i in range(20)]
    assert score([*clean, b"disgustting", *clean]) > 0.5 and score([*clean, b"worthles", *clean]) > 0.5
    assert score(clean + clean) < 0.5
    assert score([clean[0]] * 30) < 0.5  # one word again and again


def test_non_negative_risk_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(2)
    good, junk = rng.normal(1, 1, (3000, 4)), rng.normal(-1, 1, (3000, 4))
    layers = pu_quality.fit_nnpu(good[:1000], np.concatenate([good[1000:2000], junk[:600]]), 1000 / 1600, steps=300)
    out = pu_quality.forward(layers, np.concatenate([good[2000:], junk[2000:]]))[1]
    assert ((out > 0) == (np.arange(2000) < 1000)).mean() > 0.93


def test_class_prior_from_positives_and_unlabelled_rows():
    """The estimate does not see labelled negatives, so a biased choice of rated
    rows cannot move it."""
    rng = np.random.default_rng(3)
    for share in (0.15, 0.5, 0.85):
        n = int(6000 * share)
        good, junk = rng.normal(1.5, 1, (4000 + n, 4)), rng.normal(-1.5, 1, (6000 - n, 4))
        found = pu_quality.class_prior(good[:4000], rng.permutation(np.concatenate([good[4000:], junk])))
        assert abs(found - share) < 0.08


@pytest.mark.parametrize("module, column", [(toxicity, "toxic"), (pu_quality, "quality")])
def test_many_rows_of_one_id_are_one_row_of_the_fit(spark, monkeypatch, module, column):
    seen = []
    monkeypatch.setattr(module, "fitted_in_task", lambda rows, fit: seen.append(rows.count()))
    many = spark.range(10_000).selectExpr("id % 2 AS doc_id", "concat('text ', id) AS text")
    module.fit(many, spark.createDataFrame([(0, 0), (1, 1)], f"doc_id bigint, {column} int"))
    assert seen == [2]

import random

import helpers
import numpy as np
import pytest

from gapledger.llm import parity_join as pj


def run(spark, rows):
    got = pj.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(got) == len(rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def edited(rng, words, share):
    return [w if rng.random() > share else f"new{rng.randrange(10**9)}" for w in words]


def corpus(seed, sizes, copies):
    """Groups of near copies around several base texts, chains among them, a
    passage that most documents share, and exact copies."""
    rng = random.Random(seed)
    passage = [f"licence{i}" for i in range(50)]
    rows = []
    for n in sizes:
        base = [f"w{rng.randrange(3000)}" for _ in range(n)]
        chain = base
        for k in range(copies):
            chain = edited(rng, chain, 0.012) if k % 2 else chain
            text = edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04])) if k % 3 else chain
            rows.append((passage if rng.random() < 0.7 else []) + text)
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


@pytest.mark.parametrize("seed, sizes, copies", [(1, [3, 7, 20, 63, 64, 70, 150, 255, 300, 900], 12), (2, [200, 240, 1100], 60)])
def test_components_match_brute_force(spark, monkeypatch, seed, sizes, copies):
    monkeypatch.setattr(pj, "BLOCK", 16)
    rows = corpus(seed, sizes, copies)
    assert run(spark, rows) == helpers.jaccard_components(rows)


def test_tables(spark, base, docs):
    assert run(spark, docs) == helpers.jaccard_components(docs)


def test_odd_inputs(spark, odd, empty):
    got = pj.jaccard_components(odd.withColumnRenamed("lang", "component_id")).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert (by[1].n_shingles, by[1].component_id) == (0, 1) and (by[2].n_shingles, by[3].component_id) == (0, 3)
    assert by[None].component_id is None and by[None].n_shingles == 5
    assert by[6].component_id == by[5].component_id == 5 and by[7].n_shingles == 1
    assert pj.jaccard_components(empty).collect() == []


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(4)
    for n in (1, 4, 15, 16, 60, 64, 400, 1500):
        a = np.unique(rng.integers(0, 2**64, n, np.uint64))
        d = n // 5
        b = np.unique(np.concatenate([a[d:], rng.integers(0, 2**64, d // 4, np.uint64)]))
        apart = len(np.setxor1d(a, b))
        for g in set(pj.bands(len(a))) & set(pj.bands(len(b))):
            one, two = pj.parity_words(a, g), pj.parity_words(b, g)
            assert len(np.setdiff1d(one, two)) <= apart and len(one) > len(a) // 4
        size = min(pj.sketch_bits(len(a)), pj.sketch_bits(len(b))) // 8
        bits = [pj.folded(np.frombuffer(pj.bit_sketch(s), np.uint8), size) for s in (a, b)]
        assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= apart


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (150, 100)]
    got = {r.node: r.component for r in pj.components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100}


def test_the_driver_collects_no_side_of_the_joins_of_components(spark, monkeypatch):
    plans, written = [], pj.written

    def seen(df, name):
        plans.append(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple"))
        return written(df, name)

    monkeypatch.setattr(pj, "written", seen)
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)] + [(20, 21), (30, 30)], "x bigint, y bigint")
    got = {r.node: r.component for r in pj.components(edges).collect()}
    assert got == {i: 0 for i in range(9)} | {20: 20, 21: 20}
    assert len(plans) > 1 and any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_a_round_of_stars_is_one_query_of_five_shuffles(spark, monkeypatch):
    plans, written = [], pj.written

    def seen(df, name):
        plans.append(spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple"))
        return written(df, name)

    monkeypatch.setattr(pj, "written", seen)
    edges = spark.createDataFrame([(i, i + 1) for i in range(8)] + [(20, 21), (30, 30)], "x bigint, y bigint")
    status = spark._jsparkSession.sharedState().statusStore()
    before = status.executionsCount()
    out = pj.components(edges)
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert status.executionsCount() - before == len(plans)
    assert all("Union" not in p for p in plans) and max(p.count("Exchange") for p in plans) <= 7
    assert {r.node: r.component for r in out.collect()} == {i: 0 for i in range(9)} | {20: 20, 21: 20}


def test_figures_of_written_rows(spark):
    from pyspark.sql import functions as F

    for n in (0, 5):
        out, got = pj.watched(spark.range(n).where("id >= 0").distinct(), "figures", F.count(F.lit(1)), F.sum("id"))
        assert out.count() == n and got == ((5, 10) if n else (0, None))
    none = spark.createDataFrame([], "x bigint, y bigint")
    assert pj.components(none).collect() == []

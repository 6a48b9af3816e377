import numpy as np
import pytest

from gapledger.llm import multi_index as mi

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows):
    """{vec_id: (links, component)} and the set of links."""
    x = np.array([v for _, v, _ in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    link = (x @ x.T >= mi.LIMIT) & (labels[:, None] == labels[None])
    np.fill_diagonal(link, False)
    return dict(zip(ids.tolist(), zip(link.sum(axis=1).tolist(), lowest(ids, link), strict=True), strict=True)), link


def lowest(ids, link):
    out = ids.copy()
    while True:
        new = np.minimum(out, np.where(link, out[None], out.max()).min(axis=1))
        if (new == out).all():
            return out.tolist()
        out = new


def run(spark, rows, schema=SCHEMA):
    got = mi.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows) and all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    return {r.vec_id: (r.n_links, r.component_id) for r in got}


def corpus(seed, n=1500, dim=32, noise=(0.01, 0.05)):
    """Random vectors of three labels (one holds half), groups of near copies
    around some, exact and scaled copies, the same vector under two labels."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    label = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 3, n))
    for a, size in ((0, 200), (300, 40), (400, 5), (410, 2)):
        x[a:a + size] = x[a] + rng.normal(size=(size, dim)) * rng.choice(noise, size)[:, None]
        label[a:a + size] = label[a]
    x[600:620], label[600:620] = x[600], 0
    x[700], label[700] = 3 * x[701], label[701]
    x[710], label[710], label[711] = x[711], 1, 2
    return [(int(i), v.astype(np.float32).tolist(), int(k)) for i, v, k in zip(rng.permutation(5 * n)[:n], x, label, strict=True)]


@pytest.mark.parametrize("cell, chunk", [(64, 16 << 20), (8, 2000)])
def test_matches_brute_force(spark, monkeypatch, cell, chunk):
    monkeypatch.setattr(mi, "CELL", cell)
    monkeypatch.setattr(mi, "CHUNK", chunk)
    rows = corpus(3)
    assert run(spark, rows) == brute_force(rows)[0]


def test_recall_of_pairs_at_the_limit(spark, monkeypatch):
    """Pairs barely above the limit, the hardest for an index: no false link, and
    hardly one missing."""
    monkeypatch.setattr(mi, "CELL", 4)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(800, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(axis=1)[:, None] * x
    away /= np.linalg.norm(away, axis=1)[:, None]
    y = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * away
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.concatenate([x, y]).astype(np.float32))]
    want, got = brute_force(rows)[0], run(spark, rows)
    assert all(got[i][0] <= want[i][0] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())


def test_odd_inputs(spark):
    one, nan = [1.0, 0.0, 2.0], float("nan")
    rows = [(1, one, 1), (2, one, 1), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 2.0], 1),
            (8, [1.0, nan, 2.0], 1), (9, [float("inf"), 0.0, 2.0], 1), (10, [1.0, 0.0], 1), (11, [2.0, 0.0, 4.0], 1), (12, [-1.0, 0.0, -2.0], 1),
            (13, [1.0, 0.0, 2.0, 0.0], 1), (14, one, 2), (None, one, 1), (15, [1.0], 1), (16, [-0.0, 1.0], 3), (17, [0.0, 1.0], 3)]
    got = run(spark, rows)
    assert {i: got[i] for i in (1, 2, 11)} == {1: (2, 1), 2: (2, 1), 11: (2, 1)}
    assert got[16] == (1, 16) and got[17] == (1, 16) and got[None] == (0, None)
    assert all(got[i] == (0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15))
    repeated = mi.near_duplicates(spark.createDataFrame([(1, one, 1), (1, one, 1), (1, [5.0, 1.0, 0.0], 1)], SCHEMA)).collect()
    assert sorted((r.n_links, r.component_id) for r in repeated) == [(0, 1), (1, 1), (1, 1)]
    assert mi.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, [1.0, 2.0], 1, 5, "k"), (2, [1.0, 2.0], 1, 6, "k")],
                                  "vec_id bigint, embedding array<double>, label int, n_links int, key string")
    assert sorted(map(tuple, mi.near_duplicates(clash).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    model = mi.fitted(x / np.linalg.norm(x, axis=1)[:, None], 6, 0.93, 0.9)
    for half, book, (near, low) in zip(mi.split(x, 8), model.books, model.bounds(x), strict=True):
        for other, word in zip(half, near, strict=True):
            assert (low[:, word] <= ((half - other) ** 2).sum(axis=1) + 1e-9).all()

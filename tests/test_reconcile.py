"""D1/D2/D11/D16/D17 on hand-made frames: null keys, fan-out, one-sided
keys, equal totals, and the totals invariants."""

from pyspark.sql import functions as F

from gapledger.operators import reconcile as rec

L = [("a", 5), ("a", 1), ("b", 2), (None, 7), ("c", 3)]
R = [("a", 6), ("b", 1), ("b", 1), (None, 4), ("d", 9)]


def _sides(spark):
    left = rec.totals_by_key(spark.createDataFrame(L, "k string, q long"), "k", "q", "left_total")
    right = rec.totals_by_key(spark.createDataFrame(R, "k string, q long"), "k", "q", "right_total")
    return left, right


def test_separate_null_keys_and_zero_fill(spark):
    left, right = _sides(spark)
    out = rec.reconcile(left, right, "k", "left_total", "right_total", gaps_only=False)
    rows = sorted((r.k or "~", r.left_total, r.right_total, r.net_gap) for r in out.collect())
    # a: 6 vs 6 (equal, not a gap); nulls stay apart: two rows
    assert rows == [("a", 6, 6, 0), ("b", 2, 2, 0), ("c", 3, 0, 3), ("d", 0, 9, -9),
                    ("~", 0, 4, -4), ("~", 7, 0, 7)]
    gaps = rec.reconcile(left, right, "k", "left_total", "right_total")
    assert gaps.count() == 4


def test_match_null_keys(spark):
    left, right = _sides(spark)
    out = rec.reconcile(left, right, "k", "left_total", "right_total", null_key="match", gaps_only=False)
    nulls = [r for r in out.collect() if r.k is None]
    assert len(nulls) == 1 and nulls[0].net_gap == 3


def test_invariants_and_summary(spark):
    left, right = _sides(spark)
    full = rec.reconcile(left, right, "k", "left_total", "right_total", gaps_only=False)
    s = rec.summarize(full, "left_total", "right_total", key="k").first()
    assert s.left_total_sum == sum(q for _, q in L)
    assert s.right_total_sum == sum(q for _, q in R)
    assert s.net_gap_sum == s.left_total_sum - s.right_total_sum
    assert s.abs_gap_sum >= abs(s.net_gap_sum)
    assert s.accounts_total == 4 and s.accounts_with_gap == 2


def test_net_outcomes_one_pass(spark):
    df = spark.createDataFrame([("x", "W", 3), ("x", "L", -2), ("y", "L", -1), ("z", "open", 9)],
                               "k string, s string, q long")
    out = rec.net_outcomes(df, "k", F.col("s") == "W", F.col("s") == "L", F.col("q"), F.col("q"))
    got = {r.k: (r.won, r.lost, r.net) for r in out.collect()}
    assert got == {"x": (3, -2, 1), "y": (None, -1, -1)}


def test_missing_keys_is_except(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k long")
    b = spark.createDataFrame([(2,), (None,)], "k long")
    assert sorted(r.k for r in rec.missing_keys(a, b, "k").collect()) == [1, 3]


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a long, b long")
    r = rec.completeness(df, ["a", "b"]).first()
    assert (r.n_rows, r.missing_a, r.missing_b) == (3, 1, 2)


def test_drop_null_keys_and_remap(spark):
    df = spark.createDataFrame([("x", "W", 3), (None, "W", 5)], "k string, s string, q long")
    out = rec.net_outcomes(df, "k", F.col("s") == "W", F.col("s") == "L", F.col("q"), F.col("q"),
                           drop_null_keys=["k"])
    assert [r.k for r in out.collect()] == ["x"]
    m = spark.createDataFrame([("x", "org1"), ("x", "org1")], "b string, o string")
    got = rec.remap_keys(df, "k", m, "b", "o").collect()
    assert [(r.k, r.q) for r in got] == [("org1", 3)]

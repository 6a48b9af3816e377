"""Brute-force checks with one key holding a third of the rows, plus nulls."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from gapledger.operators import reconcile as rec
from gapledger.operators.labels import key_flags


def _rows(seed, n):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        r = rnd.random()
        k = "hot" if r < 1 / 3 else (None if r < 0.4 else f"k{rnd.randrange(50)}")
        out.append((k, rnd.randrange(-5, 6)))
    return out


def _expected(left, right):
    lt, rt = defaultdict(int), defaultdict(int)
    for k, q in left:
        lt[k] += q
    for k, q in right:
        rt[k] += q
    exp = []
    for k in set(lt) | set(rt):
        if k is None:  # nulls never match: one row per side
            if None in lt:
                exp.append((None, lt[None], 0))
            if None in rt:
                exp.append((None, 0, rt[None]))
        else:
            exp.append((k, lt.get(k, 0), rt.get(k, 0)))
    return sorted(((k or "~", a, b, a - b) for k, a, b in exp if a != b))


def test_reconcile_with_hot_key(spark):
    for seed in range(3):
        left, right = _rows(seed, 3000), _rows(seed + 100, 2000)
        l = rec.totals_by_key(spark.createDataFrame(left, "k string, q long"), "k", "q", "lt")
        r = rec.totals_by_key(spark.createDataFrame(right, "k string, q long"), "k", "q", "rt")
        got = sorted((x.k or "~", x.lt, x.rt, x.net_gap) for x in rec.reconcile(l, r, "k", "lt", "rt").collect())
        assert got == _expected(left, right)


def test_flags_with_hot_key(spark):
    table = spark.createDataFrame([("hot",)] * 1000 + [("a",), (None,)], "key string")
    rows = spark.createDataFrame([("hot",), ("a",), ("b",)], "k string")
    got = sorted((r.k, r.t) for r in key_flags(rows, "k", {"t": table}).collect())
    assert got == [("a", True), ("b", False), ("hot", True)]


def test_skew_join_setting_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_force_skew_split_on(spark):
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"


def test_hot_key_join_under_aggregate_is_split(spark):
    """A join on a hot key with an aggregate on the same key above it: AQE
    splits the hot partition (the session forces it) and results stay exact."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(200000).select(
            F.when(F.col("id") < 100000, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("v"), (F.col("id") % 7).alias("g"))
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("attr"))
        out = fact.join(dim, "k", "left").groupBy("k", "g").agg(F.sum("v").alias("s"), F.min("attr").alias("a"))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isSkew=true" in plan or "skew=true" in plan
        hot = {r.g: r.s for r in rows if r.k == 0}
        assert sum(hot.values()) == sum(range(100000)) + sum(i for i in range(100000, 200000) if i % 1000 == 0)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_keys_spread_in_label_joins(spark):
    """Rows without a key stay, unflagged, and are not shuffled to one task."""
    table = spark.createDataFrame([("a",), (None,)], "key string")
    rows = spark.range(4000).select(F.when(F.col("id") % 4 == 0, F.lit("a")).alias("k"), F.col("id"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = key_flags(rows, "k", {"t": table})
        got = out.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.id, r.t) for r in got) == [(i, i % 4 == 0) for i in range(4000)]
    assert len({r.part for r in got if r.k is None}) > 1


def test_surrogate_ids_over_buckets(spark):
    from gapledger.operators.ordering import surrogate_id

    rows = [(None, 3), ("b", None), ("a", 70), ("a", 5), ("b", 1), ("a", 6), (None, None)]
    df = spark.createDataFrame(rows, "p string, k long")
    got = [(r.p, r.k) for r in sorted(surrogate_id(df, ["p", "k"], [F.col("p"), F.floor(F.col("k") / 10)]).collect(), key=lambda r: r.id)]
    assert got == [(None, None), (None, 3), ("a", 5), ("a", 6), ("a", 70), ("b", None), ("b", 1)]
    assert surrogate_id(df.limit(0), ["p", "k"], [F.col("p")]).collect() == []

"""Checksum-tree reconciliation and distinct counts that roll up."""

import datetime as dt
import random

from pyspark.sql import functions as F

from gapledger.operators import reconcile as rec
from gapledger.operators import rollup


def test_distinct_counts_of_every_level(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([None, rng.randrange(100_000), rng.randrange(40)]), dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(700)))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, id bigint, day date")
    got = {(r.group, r.unit, r.period): r.n_distinct for r in rollup.distinct_by_period(df, "g", "id", "day", ["month", "quarter", "year"]).collect()}
    want = {}
    for g, i, d in rows:
        for unit, p in (("month", d.replace(day=1)), ("quarter", d.replace(month=(d.month - 1) // 3 * 3 + 1, day=1)), ("year", d.replace(month=1, day=1))):
            for name in (g, "all"):
                if i is not None:
                    want.setdefault((name, unit, p), set()).add(i)
    assert got == {k: len(v) for k, v in want.items()}


def test_checksums_find_every_gap(spark):
    rng = random.Random(4)
    left = [(k, k % 5, rng.randrange(9)) for k in range(2000)] + [(None, 1, 4)]
    right = [(k, p, t + (rng.random() < 0.01)) for k, p, t in left if rng.random() < 0.995] + [(9999, 0, 3), (9998, 0, 0)]
    a = spark.createDataFrame(left, "k bigint, p int, l bigint")
    b = spark.createDataFrame(right, "k bigint, p int, r bigint")
    want = sorted(map(str, rec.reconcile(a, b, ["k", "p"], "l", "r", gaps_only=True).collect()))
    for buckets in (1, 64, 65_536):
        assert sorted(map(str, rec.reconcile_changed(a, b, ["k", "p"], "l", "r", buckets=buckets).collect())) == want
    a = a.where("k IS NOT NULL")
    same = rec.reconcile_changed(a, a.select("k", "p", F.col("l").alias("r")), ["k", "p"], "l", "r")
    assert same.collect() == []

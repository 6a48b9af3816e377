"""Salted left join equals the plain left join, hot keys included."""

from pyspark.sql import functions as F

from gapledger.operators.joins import salted_left_join


def test_salted_left_join_same_rows(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(["hot", "hot", "cold", "none", None])],
                                 "k string, lid long")
    right = spark.range(0, 500).select(
        F.when(F.col("id") < 450, F.lit("hot")).when(F.col("id") < 499, F.lit("cold")).otherwise(F.lit(None)).alias("rk"),
        F.col("id").alias("rid"))
    plain = left.join(right, left.k == right.rk, "left")
    salted = salted_left_join(left, right, [("k", "rk")], ["rid"], rows_per_salt=60)
    a = sorted((tuple(r) for r in plain.select("lid", "k", "rk", "rid").collect()), key=lambda t: (t[0], t[3] or -1))
    b = sorted((tuple(r) for r in salted.select("lid", "k", "rk", "rid").collect()), key=lambda t: (t[0], t[3] or -1))
    assert a == b and len(a) == 2 * 450 + 49 + 2


def test_salts_that_stay_empty_add_no_rows(spark):
    """All right rows of a hot key with one salt value: the other copies of
    its left rows must not come out as unmatched rows."""
    left = spark.createDataFrame([("hot", 1), ("none", 2)], "k string, lid long")
    right = spark.createDataFrame([("hot", 5)] * 40, "rk string, rid long")
    got = salted_left_join(left, right, [("k", "rk")], ["rid"], rows_per_salt=4).collect()
    assert sorted((r.lid, r.rid) for r in got if r.rid is not None) == [(1, 5)] * 40
    assert [r.lid for r in got if r.rid is None] == [2]


def test_many_hot_keys(spark):
    left = spark.range(3000).selectExpr("id % 1500 AS k", "id AS lid")
    right = spark.range(12000).selectExpr("id % 1200 AS rk", "id AS rid")
    plain = left.join(right, left.k == right.rk, "left")
    salted = salted_left_join(left, right, [("k", "rk")], ["rid"], rows_per_salt=3)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))


def test_a_key_hot_on_both_sides_and_left_rows_without_a_key(spark):
    """A grid of left and right shares: same rows as the plain join, and rows
    without a key lie in many tasks."""
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.when(F.col("id") % 8 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))).alias("k"), F.col("id").alias("lid"))
    right = spark.range(900).select(F.when(F.col("id") < 300, F.lit("hot")).when(F.col("id") < 800, F.concat(F.lit("k"), (F.col("id") % 13).cast("string")))
                                    .alias("rk"), F.col("id").alias("rid"))
    plain = left.join(right, left.k == right.rk, "left")
    for left_by in (None, ["lid"]):
        grid = salted_left_join(left, right, [("k", "rk")], ["rid"], rows_per_salt=50, left_salt_by=left_by)
        assert grid.columns == plain.columns
        assert sorted(map(str, plain.collect())) == sorted(map(str, grid.collect()))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = salted_left_join(left, right, [("k", "rk")], ["rid"]).select("k", F.spark_partition_id().alias("p"))
        per_task = [r["count"] for r in joined.groupBy("p", "k").count().where("k IS NULL").collect()]
        assert sum(per_task) == 2000 and len(per_task) > 1 and max(per_task) < 1200
    finally:
        for k in conf:
            spark.conf.unset(k)

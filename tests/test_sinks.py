"""Writers and readers round trip."""

import os
import tempfile

import pytest

from gapledger.session import checkpoint_dir, cut_lineage
from gapledger.sources import sinks, tables


def test_round_trip(spark):
    d = tempfile.mkdtemp(prefix="gapledger-sink-")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k long, v string")
    sinks.write_csv(df, os.path.join(d, "out"))
    back = spark.read.option("header", True).csv(os.path.join(d, "out"))
    assert back.count() == 3 and back.columns == ["k", "v"]
    sinks.append_csv(df, os.path.join(d, "out"))
    assert spark.read.option("header", True).csv(os.path.join(d, "out")).count() == 6
    sinks.write_distinct_values(df, "v", os.path.join(d, "dv"))
    assert tables.count_lines(spark, os.path.join(d, "dv")).first().n_lines == 2
    sinks.write_report(df.groupBy().count(), os.path.join(d, "rep"))
    assert spark.read.json(os.path.join(d, "rep")).first()["count"] == 3


def test_normalize_names(spark):
    df = spark.createDataFrame([(1, 2)], "`contract__sent__date___c` long, `accounts.account_uuid` long")
    assert tables.normalize_column_names(df).columns == ["contract_sent_date_c", "accounts_account_uuid"]


def test_checkpoint_uses_configured_dir(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = cut_lineage(spark.range(5))
    assert df.count() == 5


def test_no_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_dir(Session())


def test_schema_follows_a_rewritten_table(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(f"{base}/part.parquet")
    assert tables.read_table(spark, base, "part").columns == ["id"]
    import time
    time.sleep(1.1)
    spark.range(3).selectExpr("id", "id * 2 AS twice").write.mode("overwrite").parquet(f"{base}/part.parquet")
    assert tables.read_table(spark, base, "part").columns == ["id", "twice"]


def test_shuffle_sizing():
    from gapledger.session import shuffle_sizing
    big = shuffle_sizing(100 * 2**40, 8000)          # 100 TB: 512 MB of input each
    assert big["spark.sql.shuffle.partitions"] == "204800"
    mid = shuffle_sizing(2**40, 8000)                # 1 TB: 2,048 by size, 16,000 by cores
    assert mid["spark.sql.shuffle.partitions"] == "16000"
    small = shuffle_sizing(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_a_repeated_run_replaces_its_own_rows(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([("a", 'say "x", then'), (None, "b")], "k string, v string")
    two = spark.createDataFrame([("c", "d")], "k string, v string")
    for df, run in ((one, "r1"), (two, "r2"), (one, "r1")):
        sinks.write_run(df, path, run)
    got = sorted(map(tuple, sinks.read_runs(spark, path, one.schema).collect()), key=str)
    assert got == sorted([("a", 'say "x", then', "r1"), (None, "b", "r1"), ("c", "d", "r2")], key=str)
    sinks.write_run(one.limit(0), path, "r1")
    assert [r.run for r in sinks.read_runs(spark, path, one.schema).collect()] == ["r2"]

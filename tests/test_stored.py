"""The ledger stored by order key: same rows, and no shuffle below its joins."""

import pytest
from pyspark.sql import functions as F

from gapledger.plans import netsales, recon
from gapledger.sources import stored, tables


@pytest.fixture(scope="module")
def folder(spark, base, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("ledger"))
    stored.store_tables(spark, base, out)
    return out


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffled_scans(df):
    """Exchanges that lie right above a scan of lineitem or orders, with
    nothing but filters and projections between."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            below = []
            for nxt in lines[i + 1:]:
                if "Join" in nxt or "Aggregate" in nxt or "Exchange" in nxt or "Window" in nxt:
                    break
                below.append(nxt)
                if "FileScan" in nxt:
                    break
            if any("FileScan" in x and ("l_orderkey" in x or "o_orderkey" in x) for x in below):
                found.append(line.strip())
    return found


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("plan", [recon.resolve_contracts, netsales.net_sales_levels, recon.label_gaps])
def test_no_shuffle_below_the_ledger_joins(spark, base, folder, no_broadcast, plan):
    assert _shuffled_scans(plan(spark, base))
    with tables.reading_stored(base, stored.open_tables(spark, folder)):
        df = plan(spark, base)
    assert [x for x in _shuffled_scans(df) if "l_orderkey" in x or "o_orderkey" in x] == []
    assert _rows(df) == _rows(plan(spark, base))


def test_opened_by_another_session(spark, base, folder):
    other = spark.newSession()
    got = stored.open_tables(other, folder)
    assert set(got) == {"lineitem", "orders"}
    for t, read in got.items():
        df = read()
        want = tables.read_table(spark, base, t)
        assert df.schema.simpleString() == want.schema.simpleString()
        assert df.count() == want.count() and df.exceptAll(other.read.parquet(f"{base}/{t}.parquet")).count() == 0


def test_a_hot_key_is_stored_without_buckets(spark, tmp_path):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    rows.write.parquet(f"{base}/part.parquet")
    for buckets, kept in ((2, 2), (64, 0)):  # a third of the rows is no load for one of two buckets
        stored.store_tables(spark, base, out, {"part": "k"}, buckets)
        assert [r.buckets for r in spark.read.schema(stored.LAYOUT).json(f"{out}/layout").collect()] == [kept]
        assert stored.open_tables(spark, out)["part"]().exceptAll(rows).count() == 0
        assert stored.open_tables(spark, out)["part"]().count() == 3000


def test_empty_table_and_null_keys(spark, tmp_path):
    base, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(None, 1), (None, 2), (5, 3)], "k long, v int").write.parquet(f"{base}/part.parquet")
    spark.createDataFrame([], "k long, v int").write.parquet(f"{base}/orders.parquet")
    stored.store_tables(spark, base, out, {"part": "k", "orders": "k"}, 3)
    got = stored.open_tables(spark, out)
    assert sorted(r.v for r in got["part"]().collect()) == [1, 2, 3] and got["orders"]().count() == 0


def test_stored_levels_are_first_shuffled_by_account_and_location(spark, base, folder, no_broadcast):
    """The sums per reservation and the window over them follow the ledger's join where its rows lie."""
    with tables.reading_stored(base, stored.open_tables(spark, folder)):
        df = netsales.net_sales_levels(spark, base)
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "Window" in plan and not any("Exchange hashpartitioning(reservation_id#" in line for line in plan.splitlines())

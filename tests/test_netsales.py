"""Net-zero transfers (26/27/28 days, two rows per reservation), signs of
transfer sums, joint-venture nulls, levels."""

import datetime as dt

from gapledger.operators import netsales as ns

D = dt.datetime


def _facts(spark):
    return spark.createDataFrame([
        (1, D(2018, 8, 1), D(2018, 8, 27), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 27), 3),
        (2, D(2018, 8, 1), D(2018, 8, 28), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 28), 4),
        (3, D(2018, 8, 1), D(2018, 8, 29), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 29), 5),
        (3, D(2018, 8, 2), D(2018, 8, 30), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 30), 6),
        (4, D(2018, 8, 1), D(2018, 9, 30), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 9, 30), 7),
        (5, D(2018, 8, 1), D(2018, 8, 30), "New", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 30), 8),
    ], "reservation_id long, sold_at timestamp_ntz, gave_notice timestamp_ntz, move_in_type string, "
       "move_out_type string, date_started date, date_ended date, real_capacity long")


def test_net_zero_filter_and_sum(spark):
    got = {r.reservation_id: (r.net_zero_upgrades, r.net_zero_downgrades)
           for r in ns.net_zero_transfers(_facts(spark)).collect()}
    # 26 days out, 27 and 28 in; two rows of reservation 3 summed (B17);
    # notice in another month out; non-transfer move-in out
    assert got == {2: (4, -4), 3: (11, -11)}


def test_detail_levels_and_signs(spark):
    ledger = spark.createDataFrame([
        (100, 2, 1, "Transfer In", "Transfer", 5, D(2018, 8, 10), D(2018, 8, 10)),
        (100, 3, 2, "Transfer Out", "Transfer", -2, D(2018, 8, 11), D(2018, 8, 11)),
        (100, 9, 1, "Move In", None, 4, D(2018, 8, 12), D(2018, 8, 12)),
        (200, 9, 2, "Transfer Out", "Transfer", -6, D(2018, 8, 12), D(2018, 8, 12)),
        (300, 9, 3, "Move In", None, 1, D(2018, 8, 12), D(2018, 8, 12)),     # JV location: excluded
        (400, 9, 9, "Move In", None, 1, D(2018, 8, 12), D(2018, 8, 12)),     # unknown location: excluded (B15)
    ], "account_id long, reservation_id long, location_id long, action_type string, transfer_type string, "
       "desks_changed long, date_reserved timestamp_ntz, date_physical_move timestamp_ntz")
    locs = spark.createDataFrame([
        (1, "L-one", "C1", "M1", "T1", "R1", "L1", dt.date(2018, 1, 1), False),
        (2, "L-two", "C2", "M2", "T1", "R1", "L2", dt.date(2017, 12, 15), False),
        (3, "L-jv", "C3", "M3", "T2", "R2", "L3", dt.date(2018, 1, 1), True),
    ], "location_id long, location_name string, city string, market string, territory string, region string, "
       "code string, opened_on date, is_joint_venture boolean")
    g = {r.account_id: r for r in ns.net_sales_detail(ledger, locs, _facts(spark), level="Global").collect()}
    assert set(g) == {100, 200}
    a = g[100]
    # transfer sum 5 - 2 = 3 > 0 -> upgrades 3 + net-zero-in (reservation 2: 4) ; downgrades: only net-zero outs (res 3: -11)
    assert (a.upgrades, a.downgrades, a.new_sales, a.churn_notice) == (7, -11, 4, 0)
    assert a.transfer_in_locations == "L-one" and a.transfer_out_locations == "L-two"
    assert a.last_date_physical_move == dt.date(2018, 8, 1)
    assert a.user_selection == "Global" and a.region is None and a.location_name is None
    b = g[200]
    assert (b.upgrades, b.downgrades) == (0, -6)
    loc = ns.net_sales_detail(ledger, locs, _facts(spark), level="Location").where("account_id = 100").collect()
    months = {r.location_name: r.month_no for r in loc}
    assert months == {"L-one": 7, "L-two": 8}
    reg = ns.net_sales_detail(ledger, locs, _facts(spark), level="Region").collect()
    assert all(r.city is None and r.region == "R1" for r in reg)
    jv = ns.net_sales_detail(ledger, locs, _facts(spark), level="Global", include_jv=True)
    # including JV markets keeps every row, unknown locations too (the filter is just True)
    assert jv.where("account_id = 300").count() == 1 and jv.where("account_id = 400").count() == 1


MOVES = ("account_id long, reservation_id long, location_id long, action_type string, transfer_type string, "
         "desks_changed long, date_reserved timestamp_ntz, date_physical_move timestamp_ntz")
PLACES = ("location_id long, location_name string, city string, market string, territory string, region string, "
          "code string, opened_on date, is_joint_venture boolean")


def _movements(spark):
    """Sums whose sign changes with the level, transfers of one reservation at
    several locations, nulls in every key."""
    return spark.createDataFrame([
        (100, 2, 1, "Transfer In", "Transfer", 5, D(2018, 8, 10), D(2018, 8, 10)),
        (100, 2, 2, "Transfer In", "Transfer", 1, D(2018, 8, 31), D(2018, 9, 2)),
        (100, 3, 2, "Transfer Out", "Transfer", -9, D(2018, 8, 11), D(2018, 8, 11)),
        (100, 3, 2, "Transfer Out", "Transfer", -9, D(2018, 8, 11), D(2018, 8, 11)),
        (100, 3, 4, "Transfer In", "Transfer", 30, D(2018, 7, 11), D(2018, 8, 11)),
        (100, 9, 1, "Move In", None, 4, D(2018, 8, 12), D(2018, 8, 12)),
        (200, 3, 2, "Transfer Out", "Transfer", -6, D(2018, 8, 12), None),
        (200, None, 2, "Transfer Out", "Transfer", -6, D(2018, 8, 12), D(2018, 8, 12)),
        (None, 2, 4, "Transfer In", "Transfer", 2, D(2018, 8, 12), D(2018, 8, 12)),
        (300, 9, 3, "Move In", None, 1, D(2018, 8, 12), D(2018, 8, 12)),
        (400, 9, 9, "Move Out", None, -1, D(2018, 8, 12), D(2018, 8, 12)),
        (400, 9, None, "Move In", None, None, D(2018, 8, 12), D(2018, 8, 12)),
        (500, 2, 1, "Transfer In", "Transfer", 2, None, D(2018, 8, 12)),
    ], MOVES)


def _places(spark):
    return spark.createDataFrame([
        (1, "L-one", "C1", "M1", "T1", "R1", "L1", dt.date(2018, 1, 1), False),
        (2, "L-two", "C2", "M1", "T1", "R1", "L2", dt.date(2017, 12, 15), False),
        (3, "L-jv", "C3", "M3", "T2", "R2", "L3", dt.date(2018, 1, 1), True),
        (4, None, None, "M3", "T3", "R2", "L4", None, False),
    ], PLACES)


def _facts_with_nulls(spark):
    f = _facts(spark)
    return f.unionByName(spark.createDataFrame([
        (None, D(2018, 8, 1), D(2018, 8, 29), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 29), 50),
        (2, D(2018, 8, 1), D(2018, 8, 29), "Desk Transfer", "Office transfer", dt.date(2018, 8, 1), dt.date(2018, 8, 29), None),
    ], f.schema))


def _sorted(df, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def test_all_levels_equal_the_six_reports(spark):
    ledger, places, facts = _movements(spark), _places(spark), _facts_with_nulls(spark)
    for unit, jv, window in (("month", False, {}), ("month", True, {}), ("quarter", True, {}),
                             ("day", False, {}), ("month", True, {"start": "2018-08-01", "end": "2018-09-01"})):
        got = ns.net_sales_levels(ns.ledger_moves(ledger, facts, unit), places, unit, jv, **window)
        want = None
        for level in ns.LEVELS:
            one = ns.net_sales_detail(ledger, places, facts, unit, level, jv, **window)
            want = one if want is None else want.unionByName(one)
        assert _sorted(got, want.columns) == _sorted(want, want.columns)
    signs = {r.select_grouping: (r.upgrades, r.downgrades) for r in ns.net_sales_levels(
        ns.ledger_moves(ledger, facts), places).where(
        "account_id = 100 and period = '2018-08-01' and (region = 'R1' or region is null) and coalesce(city, 'C2') = 'C2'").collect()}
    # location two: 1 - 18 < 0 beside net-zero ins of 4 and outs of 2 x 11; region: 6 - 18 < 0 too
    assert signs["Location"] == (4, -39) and signs["Region"] == (8, -34)


def test_all_levels_of_empty_tables(spark):
    none = ns.ledger_moves(spark.createDataFrame([], MOVES), _facts(spark).limit(0))
    assert ns.net_sales_levels(none, _places(spark)).collect() == []
    one = ns.ledger_moves(_movements(spark), _facts(spark).limit(0))
    assert ns.net_sales_levels(one, spark.createDataFrame([], PLACES)).collect() == []


def test_all_levels_read_the_ledger_once(spark, base):
    from gapledger.plans.netsales import net_sales_levels

    plan = net_sales_levels(spark, base)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum("Relation" in line and "l_orderkey" in line for line in plan.splitlines()) == 1


def test_levels_are_summed_where_the_rows_are(spark, base):
    """No level's rows are shuffled: the last exchange deals rows that are not
    yet repeated per level, into as many times more partitions as there are levels."""
    from gapledger.plans.netsales import net_sales_levels

    plan = net_sales_levels(spark, base)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("== Initial Plan ==")[-1].splitlines()
    repeated = next(i for i, line in enumerate(lines) if "Generate explode" in line and "level" in line)
    assert "Expand" not in plan and not any("Exchange" in line for line in lines[:repeated])
    dealt = next(line for line in lines[repeated:] if "Exchange" in line)
    assert "hashpartitioning(period#" in dealt and ", 24)" in dealt and "REPARTITION_BY_NUM" in dealt


def test_all_levels_of_one_account_at_many_locations(spark):
    """An account's month at 300 locations, each with both transfers, and the same moves without an account."""
    n = 300
    places = spark.range(n).selectExpr(
        "id location_id", "concat('L', id) location_name", "concat('C', id % 30) city", "concat('M', id % 10) market",
        "concat('T', id % 5) territory", "concat('R', id % 5) region", "concat('c', id) code", "date'2018-01-01' opened_on",
        "false is_joint_venture")
    rows = []
    for i in range(n):
        for account in (1, None):
            at = D(2018, 8, 1 + i % 28)
            rows += [(i, account, i, at, at, action, "Transfer", by) for action, by in (("Transfer In", 3), ("Transfer Out", -2))]
    ledger = spark.createDataFrame(rows, "reservation_id long, account_id long, location_id long, date_reserved timestamp_ntz, "
                                         "date_physical_move timestamp_ntz, action_type string, transfer_type string, desks_changed long")
    got = ns.net_sales_levels(ns.ledger_moves(ledger, _facts(spark).limit(0)), places)
    by_level = {}
    for r in got.collect():
        by_level.setdefault((r.select_grouping, r.account_id), []).append(r)
    for account in (1, None):
        assert [len(by_level[lv, account]) for lv in ns.LEVELS] == [300, 30, 10, 5, 5, 1]
        for lv in ns.LEVELS:
            found = by_level[lv, account]
            assert sum(r.upgrades for r in found) == n
            for side in ("transfer_in_locations", "transfer_out_locations"):
                assert sorted(x for r in found for x in r[side].split(", ")) == sorted(f"L{i}" for i in range(n))
                assert all(r[side].split(", ") == sorted(r[side].split(", ")) for r in found)

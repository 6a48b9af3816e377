"""D3, D5-D9 on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from gapledger.operators import attribution as att
from gapledger.operators import labels as lab


def test_first_rule_wins_and_null_is_false(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (-1, 0)], "a long, b long")
    rules = [(F.col("b") > 1, "big b"), (F.col("a") > 0, "positive a"), (F.col("a") > 1, "never")]
    got = [r.reason for r in lab.label_gaps(df, rules).orderBy("a").collect()]
    assert got == ["", "positive a", "big b"]


def test_attribution_null_country(spark):
    df = spark.createDataFrame([(True, "X", "r1", "c1"), (True, "EXC", "r2", "c2"),
                                (True, None, "r3", "c3"), (False, "X", "r4", "c4")],
                               "hd boolean, country string, a string, b string")
    for side, want in (("b", ["r1", "c2", "c3", "c4"]), ("a", ["r1", "c2", "r3", "c4"])):
        k = att.attribution_key(F.col("hd"), F.col("country"), ["EXC"], F.col("a"), F.col("b"), null_country=side)
        assert [r.k for r in df.select(k.alias("k")).collect()] == want


def test_late_moveouts_by_either_key(spark):
    ts = lambda d: dt.datetime.fromisoformat(d)
    opps = spark.createDataFrame([
        ("R1", "C1", -1, ts("2018-09-03"), 1),
        ("R2", "C2", -3, ts("2018-09-01"), 2), ("R2", "C9", -1, ts("2018-09-05"), 3),
        ("R3", "C3", 5, ts("2018-09-01"), 4),
    ], "rk string, ck string, m long, close timestamp_ntz, id long")
    out = lab.late_moveouts(opps, ["rk", "ck"], "m", "close", ["close", "id"])
    got = sorted((r.key, r.period) for r in out.collect())
    aug = dt.date(2018, 8, 1)
    # R2's first row (earliest) is -3, so R2 is out; C9 alone is in
    assert got == [("C1", aug), ("C9", aug), ("R1", aug)]


def test_same_day_pairs(spark):
    d1, d2 = dt.datetime(2018, 8, 1), dt.datetime(2018, 8, 2)
    v = spark.createDataFrame([("a", d1), ("a", d1), ("b", d1), ("b", d2), ("c", d1), ("c", d1), ("c", d1)],
                              "k string, d timestamp_ntz")
    assert [r.key for r in lab.same_day_pairs(v, "k", "d").collect()] == ["a"]


def test_legacy_keys(spark):
    opps = spark.createDataFrame([("a", "F", dt.datetime(2017, 10, 1)), ("a", "F", dt.datetime(2018, 1, 1)),
                                  ("b", "F", dt.datetime(2017, 11, 1)), ("c", "O", dt.datetime(2016, 1, 1))],
                                 "k string, s string, d timestamp_ntz")
    out = lab.legacy_keys(opps, "k", F.col("s") == "F", "d", "2017-11-01")
    assert [r.key for r in out.collect()] == ["a"]


def test_key_flag_never_multiplies(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "k string")
    table = spark.createDataFrame([("a",), ("a",), ("a",)], "key string")
    out = lab.key_flag(rows, table, [("k", "key")], "hit").orderBy("k").collect()
    assert [(r.k, r.hit) for r in out] == [("a", True), ("b", False)]


def test_resolve_contracts_by_action(spark):
    ledger = spark.createDataFrame([
        (1, "Move In", dt.datetime(2018, 8, 2)), (1, "Move Out", dt.datetime(2018, 8, 3)),
        (2, "Move In", dt.datetime(2018, 8, 2))], "reservation_id long, action_type string, date_reserved timestamp_ntz")
    reqs = spark.createDataFrame([
        (1, 10, dt.datetime(2018, 7, 31), dt.date(2018, 8, 1), None),
        (1, 10, dt.datetime(2018, 8, 5), dt.date(2018, 8, 1), None),   # duplicate start: no double row
        (2, 20, dt.datetime(2018, 6, 1), dt.date(2018, 6, 1), None)],  # outside the widened window
        "reservation_id long, agreement_id long, executed_at timestamp_ntz, started_on date, ended_on date")
    ags = spark.createDataFrame([(10, "MA-10"), (20, "MA-20")], "agreement_id long, agreement_uuid string")
    out = att.resolve_contracts(ledger, reqs, ags, "2018-08-01", "2018-09-01")
    got = sorted((r.reservation_id, r.action_type, r.agreement_uuid) for r in out.collect())
    assert got == [(1, "Move In", "MA-10"), (1, "Move Out", None), (2, "Move In", None)]


def test_key_flags_one_join(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    t1 = spark.createDataFrame([("a",), ("a",)], "key string")
    t2 = spark.createDataFrame([("b",), (None,)], "key string")
    out = lab.key_flags(rows, "k", {"x": t1, "y": t2}).collect()
    got = sorted(((r.k or "~"), r.x, r.y) for r in out)
    assert got == [("a", True, False), ("b", False, True), ("~", False, False)]


def test_requests_on_two_agreements_repeat_no_row(spark):
    ledger = spark.createDataFrame([(1, "Move In", dt.datetime(2018, 8, 2)), (1, "Move Out", dt.datetime(2018, 8, 3))],
                                   "reservation_id long, action_type string, date_reserved timestamp_ntz")
    reqs = spark.createDataFrame([
        (1, 10, dt.datetime(2018, 8, 1), dt.date(2018, 8, 1), dt.date(2018, 8, 3)),
        (1, 11, dt.datetime(2018, 8, 5), dt.date(2018, 8, 1), None),
        (1, 9, dt.datetime(2018, 8, 5), dt.date(2018, 8, 1), None)],
        "reservation_id long, agreement_id long, executed_at timestamp_ntz, started_on date, ended_on date")
    ags = spark.createDataFrame([(9, "A"), (10, "B"), (11, "C")], "agreement_id long, agreement_uuid string")
    got = sorted((r.action_type, r.agreement_uuid) for r in att.resolve_contracts(ledger, reqs, ags).collect())
    assert got == [("Move In", "C"), ("Move Out", "B")]


def test_late_moveouts_of_every_period(spark):
    opps = spark.createDataFrame([(1, "R-1", "C-1", -1, dt.datetime(2018, 1, 1)), (2, "R-2", None, -2, dt.datetime(2018, 1, 1))],
                                 "id long, rk string, ck string, m long, close timestamp_ntz")
    for unit, before in (("day", dt.date(2017, 12, 31)), ("week", dt.date(2017, 12, 25)), ("month", dt.date(2017, 12, 1)),
                         ("quarter", dt.date(2017, 10, 1)), ("year", dt.date(2017, 1, 1))):
        out = lab.late_moveouts(opps, ["rk", "ck"], "m", "close", ["close", "id"], unit=unit)
        assert sorted(map(tuple, out.collect())) == [("C-1", before), ("R-1", before)]

"""Contract resolution for every period's window at once."""

import datetime as dt

import pytest

from gapledger.functions.dates import period, shift_months
from gapledger.operators import attribution as att
from gapledger.plans import recon
from gapledger.sources import analogues as av

D = dt.datetime
LEDGER = "row long, reservation_id long, action_type string, date_reserved timestamp_ntz"
REQUESTS = "reservation_id long, agreement_id long, executed_at timestamp_ntz, started_on date, ended_on date"
DAY = dt.date(2018, 1, 1)


def _tables(spark):
    ledger = spark.createDataFrame([
        (1, 1, "Move In", D(2018, 8, 1)), (2, 1, "Move Out", D(2018, 8, 31, 23, 59)), (3, 1, "Transfer In", D(2018, 9, 1)),
        (4, 2, "Move In", D(2018, 8, 15)), (5, 3, "Move In", D(2018, 8, 15)), (6, None, "Move In", D(2018, 8, 15)),
        (7, 1, "Move In", None), (8, 1, None, D(2018, 8, 1)), (9, 1, "Other", D(2018, 8, 1)), (10, 1, "Move In", D(2018, 8, 1)),
    ], LEDGER)
    requests = spark.createDataFrame([
        (1, 10, D(2018, 7, 31), DAY, None),               # first instant of August's window
        (1, 11, D(2018, 8, 31), DAY, DAY),                # August and September
        (1, 12, D(2018, 9, 1, 23, 59, 59), DAY, None),    # the last second that August's window holds
        (1, 13, D(2018, 9, 2), DAY, None),                # September alone
        (2, 20, D(2018, 7, 30, 23, 59, 59), DAY, None),   # just before August's window
        (3, 30, D(2018, 8, 5), DAY, None), (3, 31, D(2018, 8, 5), DAY, None),   # one time: the larger agreement
        (3, None, D(2018, 8, 6), None, DAY), (None, 50, D(2018, 8, 5), DAY, None), (2, 21, None, DAY, DAY),
    ], REQUESTS)
    agreements = spark.createDataFrame([(k, f"M-{k}") for k in (10, 11, 12, 13, 20, 30, 31, 50)],
                                       "agreement_id long, agreement_uuid string")
    return ledger, requests, agreements


def test_overlapping_windows(spark):
    got = att.resolve_contracts_per_period(*_tables(spark)).collect()
    assert {r.row: r.agreement_uuid for r in got} == {
        1: "M-12", 2: "M-11", 3: "M-13", 4: None, 5: "M-31", 6: None, 7: None, 8: None, 9: None, 10: "M-12"}
    assert len(got) == 10


@pytest.mark.parametrize("unit", ["day", "month"])
def test_equals_a_run_per_window(spark, unit):
    ledger, requests, agreements = _tables(spark)
    got = {r.row: r.agreement_uuid for r in att.resolve_contracts_per_period(ledger, requests, agreements, unit).collect()}
    starts = [r.p for r in ledger.select(period("date_reserved", unit).alias("p")).distinct().collect() if r.p]
    for start in starts:
        end = shift_months(start, 1) if unit == "month" else start + dt.timedelta(days=1)
        for r in att.resolve_contracts(ledger, requests, agreements, start, end).collect():
            assert got[r.row] == r.agreement_uuid, (start, r)


def test_equals_windowed_runs_on_the_tables(spark, base):
    requests, agreements = recon.split_agreements(spark, base)
    ledger = av.ledger(spark, base)
    all_months = att.resolve_contracts_per_period(ledger, requests, agreements)
    for start in ("1995-01-01", "1996-12-01"):
        run = att.resolve_contracts(ledger, requests, agreements, start, shift_months(start, 1))
        one = all_months.where(f"period = date'{start}'").drop("period")
        assert run.count() > 0
        assert sorted(map(tuple, run.collect()), key=repr) == sorted(map(tuple, one.select(*run.columns).collect()), key=repr)


def test_empty_requests(spark):
    ledger, requests, agreements = _tables(spark)
    got = att.resolve_contracts_per_period(ledger, requests.limit(0), agreements).collect()
    assert len(got) == 10 and all(r.agreement_uuid is None for r in got)

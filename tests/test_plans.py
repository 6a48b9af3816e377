"""Plan shape checks: OR-key lookups become equi joins (R2), no Python
workers or nested-loop joins in any registered query, full joins under
null-rejecting filters become inner/left joins."""

import pytest

from gapledger.plans import recon
from gapledger.plans.registry import QUERIES

BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_or_nested_loops(spark, base, name):
    p = _plan(QUERIES[name](spark, base))
    assert not [b for b in BAD if b in p]


def test_either_key_lookup_is_equi_join(spark, base):
    p = _plan(recon.label_gaps(spark, base))
    assert "Generate explode" in p and "NestedLoop" not in p


def test_lineage_full_joins_rewritten(spark, base):
    p = _plan(recon.agreement_lineage(spark, base))
    assert "FullOuter" not in p


def test_window_filter_pushed(spark, base):
    from gapledger.operators.netsales import net_sales_detail
    from gapledger.sources import analogues as av
    df = net_sales_detail(av.ledger(spark, base), av.locations(spark, base), av.reservation_facts(spark, base),
                          start="1996-01-01", end="1996-04-01")
    assert "GreaterThanOrEqual(l_shipdate" in _plan(df)


#: Queries that write their input or output files before they return.
WRITERS = {"log_kpi", "log_runs", "gaps_csv", "summary_json",
           "resolve_contracts_stored", "label_gaps_stored", "net_sales_levels_stored"}


def test_building_a_query_starts_no_job(spark, base):
    """Once the footers are read, no query runs anything until an action."""
    for name in sorted(set(QUERIES) - WRITERS):
        QUERIES[name](spark, base)
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        try:
            QUERIES[name](spark, base)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")) == [], name


def test_window_reaches_both_scans(spark, base):
    p = _plan(QUERIES["net_sales_window"](spark, base))
    assert p.count("GreaterThanOrEqual(l_shipdate") >= 1 and p.count("GreaterThanOrEqual(o_orderdate") >= 1
    p = _plan(QUERIES["resolve_contracts_window"](spark, base))
    assert p.count("GreaterThanOrEqual(l_shipdate") >= 2


def test_sums_of_net_sales_are_hash_aggregates(spark, base):
    assert "ObjectHashAggregate" not in _plan(QUERIES["net_sales_global"](spark, base))
    p = _plan(QUERIES["net_sales_region"](spark, base))
    sums = [line for line in p.splitlines() if "ObjectHashAggregate" in line]
    assert sums and not [line for line in sums if "sum(" in line]

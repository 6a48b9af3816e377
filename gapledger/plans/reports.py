"""Report plans (D18-D24, statement-level queries) over the analogue views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import closed_range, month_of_year, open_range
from ..operators import ordering as od
from ..operators import reports as rp
from ..sources import analogues as av
from ..sources.tables import read_table

# Analogue parameters (not reference values).
IN_LIST_BRANDS = [f"Brand#{i}" for i in range(1, 70, 2)]  # 35 literals
OR_CUTOFF = "2024-01-15"
CLOSED_RANGE = ("2024-01-05", "2024-01-20")
TAG_PATTERNS = ("%click%", "%sign%")
NOTE_PATTERN = '%"k": 1%'


def funnel(spark: SparkSession, base: str) -> DataFrame:
    """Opportunities opened, won, agreements (lines) and signed (F
    lines) per month; months present in every stage."""
    o = read_table(spark, base, "orders")
    li = read_table(spark, base, "lineitem")
    return rp.funnel({
        "opps_open": (o, "o_orderdate"),
        "won": (o.where(F.col("o_orderstatus") == "F"), "o_orderdate"),
        "agreements": (li, "l_shipdate"),
        "signed": (li.where(F.col("l_linestatus") == "F"), "l_shipdate"),
    })


def funnel_six_stages(spark: SparkSession, base: str) -> DataFrame:
    """D18 with leads (views) and tours (clicks) before the four stages above,
    by month of year: events and orders share no calendar month."""
    e = read_table(spark, base, "events")
    o = read_table(spark, base, "orders")
    li = read_table(spark, base, "lineitem")
    return rp.funnel({
        "leads": (e.where(F.col("event_type") == "view"), "ts"),
        "tours": (e.where(F.col("event_type") == "click"), "ts"),
        "opps_open": (o, "o_orderdate"),
        "won": (o.where(F.col("o_orderstatus") == "F"), "o_orderdate"),
        "agreements": (li, "l_shipdate"),
        "signed": (li.where(F.col("l_linestatus") == "F"), "l_shipdate"),
    }, month_of_year_only=True)


def events_in_range(spark: SparkSession, base: str) -> DataFrame:
    """Events of a closed range; the midnight upper bound takes in that
    instant and loses the day."""
    e = read_table(spark, base, "events")
    return e.where(closed_range("ts", *CLOSED_RANGE)).groupBy("event_type").agg(F.count("event_id").alias("n"))


def compare_counts(spark: SparkSession, base: str) -> DataFrame:
    """Distinct accounts per month, won deals vs ledger rows adding
    desks."""
    opp = av.opportunities(spark, base).where(F.col("status_code") == "F")
    v = av.ledger(spark, base).where(F.col("desks_changed") > 0)
    return rp.compare_counts(opp, "account_id", "close_date", v, "account_id", "date_reserved")


def note_share(spark: SparkSession, base: str) -> DataFrame:
    """Events per day and those whose props match a note pattern."""
    e = read_table(spark, base, "events")
    return od.sort_report(rp.share(e, F.col("props").like(NOTE_PATTERN), "ts", unit="day"), ("period", "asc"))


def durations(spark: SparkSession, base: str) -> DataFrame:
    """Mean day component from order date to ship date of won deals, by
    year, month, priority and customer segment."""
    li = read_table(spark, base, "lineitem").select("l_orderkey", "l_shipdate")
    o = read_table(spark, base, "orders").where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = read_table(spark, base, "customer").select("c_custkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    j = j.select(F.col("o_orderdate").alias("created_date"), F.col("l_shipdate").alias("close_date"),
                 F.col("o_orderpriority").alias("product_type"), F.col("c_mktsegment").alias("deal_type"))
    return od.sort_report(rp.durations(j, "created_date", "close_date", ["product_type", "deal_type"]),
                          ("year", "asc"), ("month", "asc"))


def segment_volumes(spark: SparkSession, base: str) -> DataFrame:
    """Deals and won desks per month and record type. The customer's
    segment plays the type's name and its nation the type's id, so many types
    bear one name."""
    return _segment_volumes(spark, base, month_of_year_only=False)


def segment_volumes_month_of_year(spark: SparkSession, base: str) -> DataFrame:
    """D22 by month of year, as the source's statements grouped."""
    return _segment_volumes(spark, base, month_of_year_only=True)


def _segment_volumes(spark: SparkSession, base: str, month_of_year_only: bool) -> DataFrame:
    opp = av.opportunities(spark, base)
    acc = av.accounts(spark, base).select("account_id", "segment", "country_key")
    j = opp.join(acc, "account_id")
    return rp.segment_volumes(j, "created_date", "segment", "country_key", "opp_id", F.col("desks"),
                              F.col("status_code") == "F", month_of_year_only=month_of_year_only)


def reuse_conflicts(spark: SparkSession, base: str) -> DataFrame:
    """D23 over the reuse records built from events."""
    rr = av.reuse_records(spark, base)
    return rp.reuse_conflicts(rr).select("record_id", "company_id", "crm_response",
                                         "opportunity_id_found", "conflict")


def _tickets(spark: SparkSession, base: str) -> DataFrame:
    e = read_table(spark, base, "events")
    return e.select(F.col("event_id").alias("ticket_id"), F.col("event_type").alias("tag"),
                    F.to_date("ts").cast("timestamp_ntz").alias("created_at"), F.col("ts").alias("updated_at"))


def _tag_pred():
    t = F.lower(F.col("tag"))
    pred = None
    for p in TAG_PATTERNS:
        c = t.like(p)
        pred = c if pred is None else pred | c
    return pred


def tag_effort(spark: SparkSession, base: str) -> DataFrame:
    """Tickets and mean hour component per tag (tags by pattern)."""
    return od.sort_report(rp.tag_effort(_tickets(spark, base), _tag_pred()), ("n", "desc"))


def tag_effort_monthly(spark: SparkSession, base: str) -> DataFrame:
    """D24 by tag and month of year (statement 28's grouping)."""
    return rp.tag_effort(_tickets(spark, base), _tag_pred(), by_month=True)


def in_list(spark: SparkSession, base: str) -> DataFrame:
    """P14 + P25: distinct part names of 35 listed brands."""
    p = read_table(spark, base, "part")
    return rp.in_list(p, "p_brand", IN_LIST_BRANDS).select("p_name").distinct()


def or_precedence(spark: SparkSession, base: str) -> DataFrame:
    """Events per day where (after the cutoff AND a click) OR a signup;
    the OR arm is not bound by the date, as in the source."""
    e = read_table(spark, base, "events")
    t = F.lower(F.col("event_type"))
    pred = (open_range("ts", OR_CUTOFF) & t.like("%click%")) | t.like("%sign%")
    out = e.where(pred).groupBy(F.to_date("ts").alias("date")).agg(F.count("event_id").alias("n"))
    return od.sort_report(out, ("date", "asc"))


def distinct_rows(spark: SparkSession, base: str) -> DataFrame:
    """P25: distinct (user, event type) pairs of purchases."""
    e = read_table(spark, base, "events")
    return e.where(F.col("event_type") == "purchase").select("user_id", "event_type").distinct()


def payment_counts(spark: SparkSession, base: str) -> DataFrame:
    """A2 + J1: accounts per payment method (order priority plays the
    method), accounts joined from the customer table."""
    o = read_table(spark, base, "orders").select("o_custkey", "o_orderpriority")
    c = read_table(spark, base, "customer").select("c_custkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy(F.col("o_orderpriority").alias("payment_method")).agg(F.count("c_custkey").alias("n"))


def semi_flag(spark: SparkSession, base: str) -> DataFrame:
    """Every order with a flag: does it have a returned line."""
    o = read_table(spark, base, "orders").select("o_orderkey")
    r = read_table(spark, base, "lineitem").where(F.col("l_returnflag") == "R")
    return rp.flag_membership(o, "o_orderkey", r, "l_orderkey", "has_return")


def both_status(spark: SparkSession, base: str) -> DataFrame:
    """Accounts with both a won (F) and a lost (O) deal."""
    o = read_table(spark, base, "orders")
    s = F.col("o_orderstatus")
    return rp.keys_in_both(o, "o_custkey", s == "F", s == "O")


def status_by_month(spark: SparkSession, base: str) -> DataFrame:
    """Statement 2 (A13, F9): agreements per month of year and status for
    one product (ECONOMY parts), requests joining reservation and agreement."""
    r = read_table(spark, base, "part").where(F.col("p_type") == "ECONOMY").select("p_partkey")
    cr = read_table(spark, base, "lineitem").select("l_partkey", "l_orderkey")
    ma = read_table(spark, base, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    j = r.join(cr, r.p_partkey == cr.l_partkey).join(ma, F.col("l_orderkey") == ma.o_orderkey)
    out = j.groupBy(month_of_year("o_orderdate").alias("datepart"), F.col("o_orderstatus").alias("status")).agg(
        F.count("o_orderkey").alias("n"))
    return od.sort_report(out, ("datepart", "asc"))


def monthly_accounts(spark: SparkSession, base: str) -> DataFrame:
    """A3: distinct accounts with won deals per month."""
    opp = av.opportunities(spark, base).where(F.col("status_code") == "F")
    return rp.distinct_per_period(opp, "account_id", "close_date", "accounts")


def close_durations(spark: SparkSession, base: str) -> DataFrame:
    """Statement 5 (J1, P15): created and signed dates of signed agreements
    with the account's name and segment (record type)."""
    ma = av.agreements(spark, base).where(F.col("signed_at").isNotNull())
    acc = av.accounts(spark, base).select("account_id", "account_name", "segment")
    return ma.join(acc, "account_id").select("agreement_id", "created_at", "signed_at", "account_name", "segment")


def ticket_tags(spark: SparkSession, base: str) -> DataFrame:
    """Statement 30 for every ticket (A9): its tags as one string. A ticket's
    tags are distinct, so the string is bounded by the tag vocabulary."""
    from ..operators.netsales import listagg_distinct

    t = read_table(spark, base, "events").select(F.col("user_id").alias("ticket_id"), F.col("event_type").alias("tag"))
    return t.groupBy("ticket_id").agg(listagg_distinct(F.col("tag")).alias("tags"))

"""The analysts' statements on tables shaped like the source warehouse
(FIXTURES.md 1): each binds a report operator to the source column names.
Bounds are parameters, with the comparison each statement used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import closed_range, half_open, month_of_year, open_range
from ..operators import ordering as od
from ..operators import reports as rp

STAGE_WON = "Closed Won"
PRIMARY = "PrimaryReservation"


def funnel(lead: DataFrame, opportunity: DataFrame, agreements: DataFrame, tours: DataFrame,
           start, end, month_of_year_only: bool = True) -> DataFrame:
    """Leads, tours, opportunities opened and won, agreements and signed
    agreements per month (statement 9, D18). Month of year, as the source
    grouped; months missing from any stage drop out."""
    w = lambda df, c: df.where(half_open(c, start, end))
    opp = w(opportunity, "created_date")
    ma = w(agreements, "created_at")
    return rp.funnel({
        "leads": (w(lead, "created_date"), "created_date"),
        "tours": (w(tours, "created_at"), "created_at"),
        "opps_open": (opp, "created_date"),
        "won": (opp.where(F.col("stage_name") == STAGE_WON), "created_date"),
        "msas": (ma, "created_at"),
        "signed": (ma.where(F.col("signed_at").isNotNull()), "created_at"),
    }, month_of_year_only=month_of_year_only)


def compare_counts(v_transaction: DataFrame, opportunity: DataFrame, after) -> DataFrame:
    """Distinct accounts per month of year: won deals vs ledger rows adding
    desks, and the difference (statement 3, D19)."""
    crm = opportunity.where(open_range("close_date", after) & (F.col("stage_name") == STAGE_WON))
    led = v_transaction.where(open_range("date_reserved", after) & (F.col("desks_changed") > 0))
    return rp.compare_counts(crm, "account_id", "close_date", led, "account_uuid", "date_reserved",
                             month_of_year_only=True)


def notes_share(change_requests: DataFrame, after) -> DataFrame:
    """Primary requests per month of year and those with notes (statement 13, D20)."""
    cr = change_requests.where(open_range("created_at", after) & (F.col("reservation_type") == PRIMARY))
    return od.sort_report(rp.share(cr, F.col("notes").isNotNull(), "created_at", month_of_year_only=True),
                          ("period", "asc"))


def durations(opportunity: DataFrame, record_type: DataFrame, after) -> DataFrame:
    """Won deals: count and mean day part of close - created by year, month,
    product type and deal type (statement 6, D21)."""
    t = record_type.select(F.col("id").alias("rt_id"), F.col("name").alias("deal_type"))
    o = opportunity.where((F.col("stage_name") == STAGE_WON) & open_range("created_date", after))
    j = o.join(t, o.record_type_id == F.col("rt_id")).withColumnRenamed("type_c", "product_type")
    return od.sort_report(rp.durations(j, "created_date", "close_date", ["product_type", "deal_type"]),
                          ("year", "asc"), ("month", "asc"))


def segment_volumes(opportunity: DataFrame, record_type: DataFrame, start, end) -> DataFrame:
    """Deals and won desks per month of year and record type, by its id and
    name (statements 20-21, D22)."""
    t = record_type.select(F.col("id").alias("rt_id"), F.col("name").alias("record_type"))
    o = opportunity.where(half_open("created_date", start, end))
    j = o.join(t, o.record_type_id == F.col("rt_id"))
    out = rp.segment_volumes(j, "created_date", "record_type", "rt_id", "id", F.col("no_of_desks_unweighted_c"),
                             F.col("stage_name") == STAGE_WON, month_of_year_only=True)
    return od.sort_report(out, ("period", "asc"))


def reuse_conflicts(records: DataFrame, response: str, found: str = "opportunity_id_found") -> DataFrame:
    """The three kinds of reuse conflict (statements 16-18, D23); ``response``
    names the column with the CRM's response text."""
    return rp.reuse_conflicts(records, response, found)


def tag_effort(ticket_tag: DataFrame, ticket: DataFrame, patterns: Sequence[str], after,
               by_month: bool = False) -> DataFrame:
    """Tickets and mean hour part of (updated - created) per tag whose
    lower-case text matches any pattern (statements 28, 32, D24)."""
    t = ticket.where(open_range("created_at", after)).select(
        F.col("id").alias("ticket_id"), "created_at", "updated_at")
    low = F.lower(F.col("tag"))
    pred = None
    for p in patterns:
        pred = low.like(p) if pred is None else pred | low.like(p)
    return od.sort_report(rp.tag_effort(ticket_tag.select("ticket_id", "tag"), pred, tickets=t, by_month=by_month),
                          ("n", "desc"))


def ticket_tags(ticket_tag: DataFrame) -> DataFrame:
    """Each ticket's tags as one string (statement 30, A9)."""
    from ..operators.netsales import listagg_distinct

    return ticket_tag.groupBy("ticket_id").agg(listagg_distinct(F.col("tag")).alias("tags"))


def addon_names(resources: DataFrame, uuids: Sequence[str]) -> DataFrame:
    """Distinct names of the listed resources (statement 4, P14, P25)."""
    return rp.in_list(resources, "uuid", uuids).select("name").distinct()


def execution_errors(executions: DataFrame, after, before) -> DataFrame:
    """Executions with no executed requests in (after, before) (statements 7-8)."""
    return executions.where(F.col("requests_executed").isNull() & open_range("created_at", after, before)).agg(
        F.count("id").alias("n"))


def agreements_created(agreements: DataFrame, after, before) -> DataFrame:
    """Agreements created in (after, before) (the KPI denominator, A1, P10, P26)."""
    return agreements.where(open_range("created_at", after, before)).agg(F.count("uuid").alias("n"))


def payment_counts(payment_methods: DataFrame, accounts: DataFrame, start, end, accounts_after) -> DataFrame:
    """Accounts per payment method (statement 10, J1, A2)."""
    pm = payment_methods.where(half_open("created_at", start, end))
    a = accounts.where(open_range("created_at", accounts_after)).select(F.col("id").alias("a_id"))
    return pm.join(a, pm.account_id == F.col("a_id")).groupBy("payment_method").agg(F.count("a_id").alias("n"))


def merged_per_day(opportunity: DataFrame) -> DataFrame:
    """Merged opportunities per creation day (statement 24, F10, P15)."""
    out = opportunity.where(F.col("merged_on_c").isNotNull()).groupBy(F.to_date("created_date").alias("date")).agg(
        F.count("id").alias("n"))
    return od.sort_report(out, ("date", "asc"))


def tickets_by_root_cause(ticket: DataFrame) -> DataFrame:
    """Tickets per root-cause category (statement 29)."""
    return ticket.groupBy(F.col("custom_root_cause_category").alias("root")).agg(F.count("id").alias("n"))


def ids_in_both_statuses(reservations: DataFrame, change_requests: DataFrame, agreements: DataFrame,
                         description: str, after, status_a: str = "executed", status_b: str = "sent") -> DataFrame:
    """Agreements of one product present with both statuses (statement 1,
    J14): one grouped pass instead of a self join; ``n_pairs`` is the row
    count the self join would have produced."""
    r = reservations.where((F.col("description") == description) & closed_range("created_at", after)).select(
        F.col("id").alias("r_id"))
    cr = change_requests.select(F.col("reservation_id"), F.col("membership_agreement_id").alias("ma_id"))
    ma = agreements.select(F.col("id").alias("ma_id"), "status")
    j = r.join(cr, F.col("r_id") == cr.reservation_id).join(ma, "ma_id")
    return rp.keys_in_both(j, "ma_id", F.col("status") == status_a, F.col("status") == status_b)


def status_by_month(reservations: DataFrame, change_requests: DataFrame, agreements: DataFrame,
                    description: str, after) -> DataFrame:
    """Agreements per month of year and status for one product (statement 2)."""
    r = reservations.where((F.col("description") == description) & closed_range("created_at", after)).select(
        F.col("id").alias("r_id"))
    cr = change_requests.select(F.col("reservation_id"), F.col("membership_agreement_id").alias("ma_id"))
    ma = agreements.select(F.col("id").alias("ma_id"), "status", "created_at")
    j = r.join(cr, F.col("r_id") == cr.reservation_id).join(ma, "ma_id")
    out = j.groupBy(month_of_year("created_at").alias("datepart"), "status").agg(F.count("ma_id").alias("n"))
    return od.sort_report(out, ("datepart", "asc"))


def close_durations(agreements: DataFrame, account: DataFrame, record_type: DataFrame, after) -> DataFrame:
    """Created and signed dates of signed agreements with the account's name
    and record type (statement 5, J1, P15)."""
    a = account.select(F.col("uuid_c").alias("a_uuid"), F.col("name").alias("account_name"), "record_type_id")
    t = record_type.select(F.col("id").alias("rt_id"), F.col("name").alias("record_type"))
    ma = agreements.where((F.col("created_at") >= F.lit(str(after)).cast("timestamp_ntz"))
                          & F.col("signed_at").isNotNull())
    return (ma.join(a, ma.account_uuid == F.col("a_uuid")).join(t, F.col("record_type_id") == F.col("rt_id"))
              .select("created_at", "signed_at", "account_name", "record_type_id", "record_type"))


def requests_with_notes(change_requests: DataFrame, after) -> DataFrame:
    """Requests with notes created after a date (statement 12, P1, P15)."""
    return change_requests.where(open_range("created_at", after) & F.col("notes").isNotNull()).select(
        "id", "created_at", "uuid", "executed_at", "membership_agreement_id", "sf_opportunity_id",
        "account_uuid", "notes")


def primary_requests_with_notes(change_requests: DataFrame, start, end) -> DataFrame:
    """Count of primary requests with notes in [start, end) (statement 14)."""
    return change_requests.where(half_open("created_at", start, end) & (F.col("reservation_type") == PRIMARY)
                                 & F.col("notes").isNotNull()).agg(F.count("id").alias("n"))


def reuse_records_with_segment(records: DataFrame, account: DataFrame, record_type: DataFrame,
                               start, end) -> DataFrame:
    """Reuse records of a closed date range with the company's record type
    (statement 15, J1, P9)."""
    a = account.select(F.col("uuid_c").alias("a_uuid"), "record_type_id")
    t = record_type.select(F.col("id").alias("rt_id"), F.col("name").alias("record_type"))
    r = records.where(closed_range("created_at", start, end))
    return (r.join(a, r.company_uuid == F.col("a_uuid")).join(t, F.col("record_type_id") == F.col("rt_id"))
              .drop("a_uuid", "rt_id", "record_type_id"))


def merge_tickets_per_day(ticket: DataFrame, after) -> DataFrame:
    """Tickets per day: created after the date with "merge" in the subject,
    or any ticket with "merging" in it -- the OR arm is not bound by the
    date, as in the source (statement 22, P21)."""
    subj = F.lower(F.col("subject"))
    pred = (open_range("created_at", after) & subj.like("%merge%")) | subj.like("%merging%")
    out = ticket.where(pred).groupBy(F.to_date("created_at").alias("date")).agg(F.count("id").alias("n"))
    return od.sort_report(out, ("date", "asc"))


def tickets_matching_per_month(ticket: DataFrame, pattern: str, after) -> DataFrame:
    """Tickets whose subject matches ``pattern`` per month of year
    (statement 25, F9, P17; case-sensitive, as the source's LIKE)."""
    t = ticket.where(open_range("created_at", after) & F.col("subject").like(pattern))
    return t.groupBy(month_of_year("created_at").alias("month_created")).agg(F.count("id").alias("n"))


def solved_tickets(ticket: DataFrame, category: str, after, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct solved tickets of a category created from a date (statements
    26-27, P25): all columns, or the given ones."""
    t = ticket.where((F.col("created_at") >= F.lit(str(after)).cast("timestamp_ntz"))
                     & (F.col("custom_digital_category") == category) & (F.col("status") == "solved"))
    return (t.select(*columns) if columns else t).distinct()

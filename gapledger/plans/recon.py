"""Reconciliation plans over the analogue views.

Each function takes (spark, base) and returns a lazy DataFrame over the whole
tables. No action runs here (only the footers of a table are read, once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import period
from ..operators import attribution as att
from ..operators import labels as lab
from ..operators import reconcile as rec
from ..operators import rollup
from ..sources import analogues as av
from ..sources.tables import read_table

WON_CODE, LOST_CODE = "F", "O"
# Analogue parameters for the labeller (not reference values).
OWN_ACCOUNT_TEXT = "Customer#00000001"
MOVEOUT_COUNTRY = "NATION_5"
LEGACY_CUTOFF = "1995-06-01"
NULL_KEY_PRIORITY = "2-HIGH"
WINDOW_START, WINDOW_END = "1995-01-10", "1996-01-10"


def _won():
    return F.col("status_code") == WON_CODE


def _lost():
    return F.col("status_code") == LOST_CODE


def crm_by_account(spark: SparkSession, base: str, unit: str = "month") -> DataFrame:
    opp = av.opportunities(spark, base).withColumn("period", period("close_date", unit))
    return rec.net_outcomes(opp, ["account_id", "period"], _won(), _lost(),
                            F.col("desks"), F.col("total_desks_net"),
                            names=("won", "lost", "crm_total"))


def ledger_by_account(spark: SparkSession, base: str, unit: str = "month") -> DataFrame:
    v = av.ledger(spark, base).withColumn("period", period("date_reserved", unit))
    return rec.totals_by_key(v, ["account_id", "period"], "desks_changed", "ledger_total")


def reconcile_accounts(spark: SparkSession, base: str, gaps_only: bool = True) -> DataFrame:
    """Flagship (D1 + D2): CRM net desks vs ledger desks per account and
    month, every month of the data, gap rows only."""
    crm = crm_by_account(spark, base).select("account_id", "period", "crm_total")
    led = ledger_by_account(spark, base)
    return rec.reconcile(crm, led, ["account_id", "period"], "crm_total", "ledger_total",
                         gaps_only=gaps_only)


def reconcile_changed(spark: SparkSession, base: str) -> DataFrame:
    """D1 by checksums: the flagship's gap rows, joining only the buckets of
    (account, month) in which the two systems differ."""
    crm = crm_by_account(spark, base).select("account_id", "period", "crm_total")
    return rec.reconcile_changed(crm, ledger_by_account(spark, base), ["account_id", "period"], "crm_total", "ledger_total")


def distinct_accounts(spark: SparkSession, base: str) -> DataFrame:
    """A3 at every level: distinct accounts per month, quarter and year, of each
    system and of both together, from one table of bitmaps."""
    rows = av.opportunities(spark, base).select(F.lit("crm").alias("system"), "account_id", F.col("close_date").alias("day")).unionByName(
        av.ledger(spark, base).select(F.lit("ledger").alias("system"), "account_id", F.col("date_reserved").alias("day")))
    return rollup.distinct_by_period(rows, "system", "account_id", "day", ["month", "quarter", "year"])


def reconcile_summary(spark: SparkSession, base: str) -> DataFrame:
    """D11 over the full (not gap-only) reconciliation."""
    full = reconcile_accounts(spark, base, gaps_only=False)
    return rec.summarize(full, "crm_total", "ledger_total", key="account_id", period="period")


def net_outcomes(spark: SparkSession, base: str) -> DataFrame:
    """D2 alone: won, lost and net desks per account over all time."""
    opp = av.opportunities(spark, base)
    out = rec.net_outcomes(opp, "account_id", _won(), _lost(), F.col("desks"),
                           F.col("total_desks_net"), names=("won", "lost", "net"))
    return out.select("account_id",
                      F.coalesce("won", F.lit(0)).alias("won"),
                      F.coalesce("lost", F.lit(0)).alias("lost"), "net")


def crm_contract_keys(spark: SparkSession, base: str) -> DataFrame:
    """Opportunities with their attribution key (D3, CRM side): hot-desk
    deals outside the excluded nations by reservation, else by contract; a
    null country goes by reservation."""
    opp = av.opportunities(spark, base)
    acc = av.accounts(spark, base).select("account_id", "country", "country_key")
    o = opp.join(acc, "account_id", "left")
    key = att.attribution_key(F.col("type_c") == av.HOT_DESK_PRIORITY, F.col("country"),
                              av.EXCLUDED_NATIONS, F.col("reservation_key"),
                              F.col("contract_key"), null_country="a")
    return o.withColumn("attributed_key", key)


def attribution_key(spark: SparkSession, base: str) -> DataFrame:
    """D3 per opportunity."""
    return crm_contract_keys(spark, base).select("opp_id", "account_id", "country", "attributed_key")


def resolved_ledger(spark: SparkSession, base: str, start=None, end=None) -> DataFrame:
    """Ledger rows with their agreement (D9) and attribution key (D3,
    ledger side: a null country goes by contract)."""
    v = att.resolve_contracts(av.ledger(spark, base), av.change_requests(spark, base),
                              av.agreements(spark, base), start, end)
    loc = av.locations(spark, base).select("location_id", "country", "country_key")
    v = v.join(loc, "location_id", "left")
    key = att.attribution_key(F.col("reservable_type") == av.HOT_DESK_LEDGER, F.col("country"),
                              av.EXCLUDED_NATIONS,
                              F.concat(F.lit("R-"), F.col("account_id").cast("string")),
                              F.col("agreement_uuid"), null_country="b")
    return v.withColumn("attributed_key", key)


def _per_agreement(v: DataFrame) -> DataFrame:
    return v.groupBy("account_id", "agreement_uuid").agg(
        F.sum("desks_changed").alias("desks_changed"), F.count(F.lit(1)).alias("n_rows"))


def resolve_contracts(spark: SparkSession, base: str) -> DataFrame:
    """Ledger desks per account and resolved agreement (null when the
    reservation has no qualifying request)."""
    return _per_agreement(resolved_ledger(spark, base))


def resolve_contracts_window(spark: SparkSession, base: str) -> DataFrame:
    """D9 in a run window (P8, F14): ledger rows of the window, requests
    executed from a day before it to a day after it."""
    return _per_agreement(resolved_ledger(spark, base, WINDOW_START, WINDOW_END))


def resolve_contract_choice(spark: SparkSession, base: str) -> DataFrame:
    """D9 where a reservation has requests on several agreements: the latest
    one counts, and no ledger row is repeated."""
    return _per_agreement(att.resolve_contracts(av.ledger(spark, base), *split_agreements(spark, base)))


def resolve_contracts_monthly(spark: SparkSession, base: str) -> DataFrame:
    """D9 for every month's run window at once (P8, F14): ledger desks per
    month, account and agreement."""
    v = att.resolve_contracts_per_period(av.ledger(spark, base), *split_agreements(spark, base))
    return v.groupBy("period", "account_id", "agreement_uuid").agg(
        F.sum("desks_changed").alias("desks_changed"), F.count(F.lit(1)).alias("n_rows"))


def split_agreements(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Requests and agreements where a reservation has up to three agreements."""
    li = read_table(spark, base, "lineitem")
    agreement = F.col("l_orderkey") * 10 + F.col("l_linenumber") % 3
    requests = av.change_requests(spark, base).join(
        li.select("l_orderkey", "l_linenumber").withColumn("split_id", agreement),
        (F.col("reservation_id") == F.col("l_orderkey")) & (F.col("line_no") == F.col("l_linenumber"))).select(
        "reservation_id", F.col("split_id").alias("agreement_id"), "executed_at", "started_on", "ended_on")
    agreements = li.select(agreement.alias("agreement_id")).distinct().withColumn(
        "agreement_uuid", F.concat(F.lit("M-"), F.col("agreement_id").cast("string")))
    return requests, agreements


def reconcile_null_keys(spark: SparkSession, base: str) -> DataFrame:
    """D1 in the regime where null keys of the two sides match."""
    crm = av.opportunities(spark, base).where(_won()).withColumn(
        "key", F.when(F.col("type_c") != NULL_KEY_PRIORITY, F.col("contract_key")))
    led = resolved_ledger(spark, base).withColumn("key", F.col("agreement_uuid"))
    return rec.reconcile(rec.totals_by_key(crm, "key", "desks", "crm_total"),
                         rec.totals_by_key(led, "key", "desks_changed", "ledger_total"),
                         "key", "crm_total", "ledger_total", null_key="match")


def remap_accounts(spark: SparkSession, base: str) -> DataFrame:
    """Ledger desks per organisation; accounts of a nation form one, and
    accounts outside the map (segment MACHINERY) drop out."""
    key_map = av.accounts(spark, base).where(F.col("segment") != "MACHINERY").select(
        F.col("account_id").cast("string").alias("from"), F.concat(F.lit("ORG-"), F.col("country")).alias("to"))
    v = av.ledger(spark, base).withColumn("account_id", F.col("account_id").cast("string"))
    return rec.totals_by_key(rec.remap_keys(v, "account_id", key_map, "from", "to"), "account_id", "desks_changed", "desks")


def contract_sides(spark: SparkSession, base: str):
    """Both sides at (account, attribution key, month) grain. The country is
    carried as its integer key (a fixed-width buffer keeps the aggregate
    hash-based); names are attached after the join."""
    key = ["account_id", "attributed_key", "period"]
    crm = crm_contract_keys(spark, base).withColumn("period", period("close_date"))
    crm = rec.net_outcomes(crm, key, _won(), _lost(), F.col("desks"), F.col("total_desks_net"),
                           attrs=["country_key"], names=("won", "lost", "crm_total"),
                           drop_null_keys=["account_id"])
    crm = crm.select(*key, "country_key", "crm_total")
    led = resolved_ledger(spark, base).withColumn("period", period("date_reserved"))
    led = rec.totals_by_key(led, key, "desks_changed", "ledger_total", attrs=["country_key"])
    return key, crm, led


def reconcile_contracts(spark: SparkSession, base: str, gaps_only: bool = True) -> DataFrame:
    """D1 at contract grain: CRM vs resolved ledger per (account,
    attribution key, month), country from the ledger side first."""
    key, crm, led = contract_sides(spark, base)
    g = rec.reconcile(crm, led, key, "crm_total", "ledger_total", attrs=["country_key"], prefer="right",
                      gaps_only=gaps_only)
    g = g.join(F.broadcast(av.countries(spark, base)), "country_key", "left")
    return g.select(*key, "country", "crm_total", "ledger_total", "net_gap", "abs_gap")


def late_moveouts(spark: SparkSession, base: str) -> DataFrame:
    """(key, month) whose move-out was booked in the next month."""
    opp = av.opportunities(spark, base)
    return lab.late_moveouts(opp, ["reservation_key", "contract_key"], "total_desks_net",
                             "close_date", ["close_date", "opp_id"])


def same_day_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Reservations with exactly two ledger rows in one ship month (the
    month plays the date). The two columns are the line items' own: no join."""
    v = read_table(spark, base, "lineitem").select(
        F.concat(F.lit("C-"), F.col("l_orderkey").cast("string")).alias("reservation_key"),
        period("l_shipdate").alias("date_reserved"))
    return lab.same_day_pairs(v, "reservation_key", "date_reserved")


def legacy_keys(spark: SparkSession, base: str) -> DataFrame:
    """Reservations whose first won deal closed before the cutoff."""
    opp = av.opportunities(spark, base)
    return lab.legacy_keys(opp, "reservation_key", _won(), "close_date", LEGACY_CUTOFF)


def label_gaps(spark: SparkSession, base: str, gaps: DataFrame | None = None) -> DataFrame:
    """Every contract-grain gap row (``gaps``, or those of
    ``reconcile_contracts``) with its first matching reason."""
    gaps = reconcile_contracts(spark, base) if gaps is None else gaps
    names = av.accounts(spark, base).select("account_id", "account_name")
    g = gaps.join(names, "account_id", "left")
    # Both lookups are keyed by the attribution key alone (the period of the
    # late move-outs is a residual test), so the gap rows are shuffled once.
    g = lab.key_flags(g, "attributed_key", {
        "same_day": same_day_pairs(spark, base),
        "legacy": legacy_keys(spark, base),
        "reused": av.reuse_records(spark, base).select(F.col("agreement_uuid").alias("key")),
    })
    g = lab.key_flag(g, late_moveouts(spark, base), [("attributed_key", "key")], "late_moveout",
                     same_date=[("period", "period")])
    crm, led, key = F.col("crm_total"), F.col("ledger_total"), F.col("attributed_key")
    rules = [
        (F.contains(F.col("account_name"), F.lit(OWN_ACCOUNT_TEXT)), lab.LABEL_OWN_ACCOUNT),
        ((F.col("country") == MOVEOUT_COUNTRY) & (led < 0), lab.LABEL_CHINA_MOVEOUT),
        (key.isNull() | (key == ""), lab.LABEL_NO_AGREEMENT),
        ((led < crm) & F.col("late_moveout"), lab.LABEL_LATE_MOVEOUT),
        ((led == 0) & (crm == 1) & F.col("same_day"), lab.LABEL_SAME_TIME),
        ((led == -1) & (crm == 0) & F.col("legacy"), lab.LABEL_OLD_HD),
        (F.col("reused"), lab.LABEL_REUSE),
    ]
    out = lab.label_gaps(g, rules)
    return out.select("account_id", "account_name", "attributed_key", "period", "country",
                      "crm_total", "ledger_total", "net_gap", "abs_gap", "reason")


def enrich_gaps(spark: SparkSession, base: str) -> DataFrame:
    """Contract-grain gap rows with the reuse records of the same
    agreement and company (left join keeps every gap row)."""
    gaps = reconcile_contracts(spark, base)
    rr = av.reuse_records(spark, base).select(
        "agreement_uuid", "company_id", "contract_event_type", "crm_response", "record_id")
    out = rec.enrich_gaps(gaps, rr, [("attributed_key", "agreement_uuid"), ("account_id", "company_id")],
                          salt_by=["record_id"])
    return out.select("account_id", "attributed_key", "period", "net_gap",
                      "contract_event_type", "crm_response", "record_id")


def gaps_with_lineage(spark: SparkSession, base: str) -> DataFrame:
    """Gap rows with every primary request of their agreement."""
    gaps = reconcile_contracts(spark, base).select("account_id", "attributed_key", "period", "net_gap")
    lineage = agreement_lineage(spark, base).select("ma_uuid", "reservation_id", "reservable")
    return rec.enrich_gaps(gaps, lineage, [("attributed_key", "ma_uuid")], salt_by=["reservation_id"]).drop("ma_uuid")


def reuse_with_gaps(spark: SparkSession, base: str) -> DataFrame:
    """The right merge: every reuse record with the gap rows of its
    agreement."""
    gaps = reconcile_contracts(spark, base).select("attributed_key", "period", "net_gap")
    rr = av.reuse_records(spark, base).select("agreement_uuid", "record_id", "contract_event_type")
    return rec.enrich_gaps(gaps, rr, [("attributed_key", "agreement_uuid")], how="right", salt_by=["period"]).select(
        "record_id", "agreement_uuid", "contract_event_type", "period", "net_gap")


def missing_keys(spark: SparkSession, base: str) -> DataFrame:
    """Order keys with no ledger line."""
    return rec.missing_keys(read_table(spark, base, "orders"), read_table(spark, base, "lineitem"),
                            "o_orderkey", "l_orderkey")


COMPLETENESS_COLS = ["contract_sent_date", "contract_id", "contract_signed_on"]


def _opportunity_contract_dates(spark: SparkSession, base: str) -> DataFrame:
    """Opportunities with sent date (first ship date of the order), contract
    (a returned line) and signed date (a shipped F line); null when absent.
    Lines are reduced per order before the join, so orders never repeat."""
    li = read_table(spark, base, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("contract_sent_date"),
        F.min(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("contract_id"),
        F.min(F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))).alias("contract_signed_on"))
    o = read_table(spark, base, "orders").select("o_orderkey")
    return o.join(li, o.o_orderkey == li.l_orderkey, "left")


def completeness(spark: SparkSession, base: str) -> DataFrame:
    """Counts of opportunities lacking each value."""
    return rec.completeness(_opportunity_contract_dates(spark, base), COMPLETENESS_COLS)


def incomplete_rows(spark: SparkSession, base: str) -> DataFrame:
    """The opportunities lacking any of the values, with flags."""
    return rec.incomplete_rows(_opportunity_contract_dates(spark, base), COMPLETENESS_COLS, keep=["o_orderkey"])


def agreement_lineage(spark: SparkSession, base: str) -> DataFrame:
    """Primary requests with agreement and reservation (resource)."""
    cr = av.change_requests(spark, base)
    ma = av.agreements(spark, base)
    r = read_table(spark, base, "part").select(
        F.col("p_partkey").alias("reservation_id"), F.col("p_name").alias("reservable"))
    return att.agreement_lineage(cr, ma, r)

"""The source's reports on tables shaped like its warehouse (FIXTURES.md 1).

The analogue plans run the operators on the test tables; these functions
bind the same operators to the column names of the source systems, with the
source's fixed values and its run window ``[start, end)``. Inputs are
DataFrames (read them with ``spark.table`` or a reader); nothing runs here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import half_open, period, period_in_range, shift_months
from ..operators import attribution as att
from ..operators import labels as lab
from ..operators import netsales as ns
from ..operators import reconcile as rec

# Fixed values of the source systems.
EXCLUDED_COUNTRIES = ["CHN", "ARG", "COL", "PER", "IND", "RUS", "CHL", "KOR"]
HOT_DESK_TYPE = "Hot Desk"
HOT_DESK_RESERVABLE = "HotDesk"
ENTERPRISE_SEGMENT = "Enterprise Solutions"
HOT_DESK_CANCEL_REASON = "Hot Desk Contract Canceled New Opportunity"
EXCLUDED_REGION = "India"
STAGE_WON = "Closed Won"
STAGE_LOST = "Closed Lost"
WON_EXCLUDED_PATTERN_BY_ACCOUNT = "%upgrade%"
WON_EXCLUDED_PATTERN_BY_CONTRACT = "%downgrade%"
LEGACY_CUTOFF = "2017-11-01"
CHINA = "CHN"


def _billing(billing_account: DataFrame) -> DataFrame:
    """Billing accounts de-duplicated on (id, uuid, name)."""
    return billing_account.select(F.col("id").alias("b_id"), F.col("uuid_c").alias("account_uuid"),
                                  F.col("name").alias("account_name")).distinct()


def crm_by_account(opportunity: DataFrame, billing_account: DataFrame, unit: str, start, end,
                   lost_measure: str = "no_of_desks_unweighted_c") -> DataFrame:
    """Won + lost desks per (billing account, period) (D2, P11 with R1).

    Lost: stage lost, net desks below zero; won: stage won and contract type
    not an upgrade (or none); both outside the excluded region (a null region
    drops out, as ``<>`` does). The source summed the unweighted desks of
    lost deals although it filtered on the net desks (B7); ``lost_measure``
    chooses."""
    o = opportunity.where(period_in_range("close_date", unit, start, end)
                          & (F.col("region_name_c") != EXCLUDED_REGION))
    lost = (F.col("stage_name") == STAGE_LOST) & (F.col("total_desks_reserved_net_c") < 0)
    won = (F.col("stage_name") == STAGE_WON) & (
        ~F.lower(F.col("contract_type_c")).like(WON_EXCLUDED_PATTERN_BY_ACCOUNT) | F.col("contract_type_c").isNull())
    o = o.join(_billing(billing_account), o.billing_account_c == F.col("b_id"), "left")
    o = o.withColumn("period", period("close_date", unit))
    return rec.net_outcomes(o, ["account_uuid", "period"], won, lost, F.col("no_of_desks_unweighted_c"),
                            F.col(lost_measure), names=("won", "lost", "crm_total"))


def net_sales(v_transaction: DataFrame, dim_location: DataFrame, fact_reservation: DataFrame,
              dim_account: DataFrame, unit: str = "month", level: str = "Global",
              include_jv: bool = False, start=None, end=None) -> DataFrame:
    """The net-sales report (D4) on the ledger and its dimensions."""
    v = v_transaction.select(
        F.col("account_uuid").alias("account_id"), F.col("reservation_uuid").alias("reservation_id"),
        F.col("location_uuid").alias("location_id"), "action_type", "transfer_type", "desks_changed",
        F.col("date_reserved_local").alias("date_reserved"), "date_physical_move")
    t = dim_location.select(
        F.col("location_uuid").alias("location_id"), "location_name", "city",
        F.col("sales_market").alias("market"), "territory", "region", "code", "opened_on", "is_joint_venture")
    f = fact_reservation.select(
        F.col("reservation_uuid").alias("reservation_id"), F.col("sold_at_local").alias("sold_at"),
        F.col("gave_notice_local").alias("gave_notice"), "move_in_type", "move_out_type",
        "date_started", "date_ended", "real_capacity")
    detail = ns.net_sales_detail(v, t, f, unit, level, include_jv, start, end, transfer_lists=False)
    acc = dim_account.select(F.col("account_uuid").alias("account_id"),
                             F.col("account_uuid").alias("dim_account_uuid")).distinct()
    # one name per account (the smallest in the window), so the report never repeats a row
    names = v_transaction.where(period_in_range("date_reserved_local", unit, start, end)).groupBy(F.col("account_uuid").alias("account_id")).agg(
        F.min("account_name").alias("account_name"))
    rep = detail.groupBy("account_id", "period").agg(
        F.coalesce(F.sum(F.col("upgrades") + F.col("new_sales")), F.lit(0)).alias("net_sales"))
    rep = rep.join(acc, "account_id", "left").join(names, "account_id", "left")
    return rep.select("account_name", F.col("dim_account_uuid").alias("account_uuid"),
                      F.col("period").alias("close_date"), "net_sales")


def aggregate_reconciliation(opportunity, billing_account, v_transaction, dim_location, fact_reservation,
                             dim_account, unit: str, start, end) -> tuple[DataFrame, DataFrame]:
    """CRM vs net-sales report per account and period: (gap rows, summary)
    (D1, D11). The key includes the period (B5)."""
    crm = crm_by_account(opportunity, billing_account, unit, start, end).select(
        "account_uuid", "period", "crm_total", F.lit(None).cast("string").alias("account_name"))
    rep = net_sales(v_transaction, dim_location, fact_reservation, dim_account, unit, "Global", False, start, end)
    led = rep.select(F.col("account_uuid"), F.col("close_date").alias("period"),
                     F.col("net_sales").alias("ledger_total"), "account_name")
    full = rec.reconcile(crm, led, ["account_uuid", "period"], "crm_total", "ledger_total", attrs=["account_name"],
                         gaps_only=False)
    gaps = full.where(F.col("net_gap") != 0)
    return gaps, rec.summarize(full, "crm_total", "ledger_total", "account_uuid", "period")


def _opp_country(opportunity: DataFrame, locations: DataFrame) -> DataFrame:
    loc = locations.select(F.col("uuid").alias("l_uuid"), F.col("country_code"))
    return opportunity.join(loc, opportunity.building_uuid_c == F.col("l_uuid"), "left")


def crm_by_contract(opportunity: DataFrame, billing_account: DataFrame, locations: DataFrame,
                    start, end) -> DataFrame:
    """Won + lost desks per attributed contract (D2, D3 CRM side)."""
    o = _opp_country(opportunity.where(half_open("close_date", start, end)), locations)
    o = o.join(_billing(billing_account), o.billing_account_c == F.col("b_id"), "left")
    country = F.col("country_code")
    won = (F.col("stage_name") == STAGE_WON) & (
        ~F.lower(F.col("contract_type_c")).like(WON_EXCLUDED_PATTERN_BY_CONTRACT) | F.col("contract_type_c").isNull())
    lost = (F.col("stage_name") == STAGE_LOST) & (F.col("total_desks_reserved_net_c") < 0)
    hot_won = F.col("type_c") == HOT_DESK_TYPE
    hot_lost = hot_won | ((F.col("segment_c") == ENTERPRISE_SEGMENT)
                          & (F.col("other_lost_reason_c") == HOT_DESK_CANCEL_REASON))
    kind = F.when(lost, hot_lost).otherwise(hot_won)
    key = att.attribution_key(kind, country, EXCLUDED_COUNTRIES, F.col("reservation_uuid_c"),
                              F.col("contract_uuid_c"), null_country="a")
    o = o.withColumns({"contract_uuid": key, "opportunity_name": F.col("name")})
    return rec.net_outcomes(o, "contract_uuid", won, lost, F.col("no_of_desks_unweighted_c"),
                            F.col("total_desks_reserved_net_c"),
                            attrs=["account_uuid", "account_name", "country_code", "opportunity_name"],
                            names=("won", "lost", "crm_total"), drop_null_keys=["account_uuid", "account_name"])


def ledger_by_contract(v_transaction: DataFrame, locations: DataFrame, reservations: DataFrame,
                       change_requests: DataFrame, agreements: DataFrame, start, end) -> DataFrame:
    """Ledger desks per attributed contract (D9 + D3 ledger side)."""
    r = reservations.select(F.col("uuid").alias("r_uuid"), F.col("id").alias("r_id")).distinct()
    v = v_transaction.join(r, v_transaction.reservation_uuid == F.col("r_uuid"), "left")
    v = v.select(F.col("r_id").alias("reservation_id"), "account_uuid", "account_name", "location_uuid",
                 "action_type", "desks_changed", F.col("date_reserved_local").alias("date_reserved"),
                 "reservable_type", "reservation_uuid")
    reqs = change_requests.select("reservation_id", F.col("membership_agreement_id").alias("agreement_id"),
                                  "executed_at", F.col("reservation_started_on").alias("started_on"),
                                  F.col("reservation_ended_on").alias("ended_on"))
    ma = agreements.select(F.col("id").alias("agreement_id"), F.col("uuid").alias("agreement_uuid")).distinct()
    v = att.resolve_contracts(v, reqs, ma, start, end)
    loc = locations.select(F.col("uuid").alias("l_uuid"), "country_code")
    v = v.join(loc, v.location_uuid == F.col("l_uuid"), "left")
    key = att.attribution_key(F.col("reservable_type") == HOT_DESK_RESERVABLE, F.col("country_code"),
                              EXCLUDED_COUNTRIES, F.col("reservation_uuid"), F.col("agreement_uuid"))
    v = v.withColumn("contract_uuid", key)
    return rec.totals_by_key(v, "contract_uuid", "desks_changed", "ledger_total",
                             attrs=["account_uuid", "account_name", "country_code"])


def row_level_reconciliation(opportunity, billing_account, locations, v_transaction, reservations,
                             change_requests, agreements, reuse_records, start, end,
                             own_company_text: str = "") -> DataFrame:
    """Gap rows per contract with the opportunity's name (the smallest of a
    contract; null on ledger-only rows) and the first matching reason (D1, D5-D8).
    ``own_company_text`` is matched inside account names by rule 1 (the own
    company's name; empty: the rule never holds)."""
    crm = crm_by_contract(opportunity, billing_account, locations, start, end)
    led = ledger_by_contract(v_transaction, locations, reservations, change_requests, agreements, start, end)
    led = led.withColumn("opportunity_name", F.lit(None).cast("string"))
    gaps = rec.reconcile(crm.select("contract_uuid", "account_uuid", "account_name", "country_code",
                                    "opportunity_name", "crm_total"),
                         led, "contract_uuid", "crm_total", "ledger_total",
                         attrs=["account_uuid", "account_name", "country_code", "opportunity_name"], prefer="right")
    s1, e1 = shift_months(start, 1), shift_months(end, 1)
    nxt = opportunity.where(half_open("close_date", s1, e1) & (F.col("total_desks_reserved_net_c") < 0))
    late = (nxt.select(F.explode(F.array("reservation_uuid_c", "contract_uuid_c")).alias("key"),
                       F.struct("close_date", "id").alias("ord"), F.col("total_desks_reserved_net_c").alias("m"))
               .where(F.col("key").isNotNull()).groupBy("key").agg(F.min_by("m", "ord").alias("first_m"))
               .where(F.col("first_m") == -1).select("key"))
    same = lab.same_day_pairs(v_transaction, "reservation_uuid", "date_reserved_local")
    legacy = lab.legacy_keys(opportunity, "reservation_uuid_c", F.col("stage_name") == STAGE_WON,
                             "close_date", LEGACY_CUTOFF)
    reused = reuse_records.where(half_open("created_at", start, end)).select(
        F.col("membership_agreement_uuid").alias("key"))
    g = lab.key_flags(gaps, "contract_uuid", {"late": late, "same_day": same, "legacy": legacy, "reused": reused})
    led_t, crm_t, key = F.col("ledger_total"), F.col("crm_total"), F.col("contract_uuid")
    rules = [
        (F.contains(F.col("account_name"), F.lit(own_company_text)) if own_company_text else F.lit(False),
         lab.LABEL_OWN_ACCOUNT),
        ((F.col("country_code") == CHINA) & (led_t < 0), lab.LABEL_CHINA_MOVEOUT),
        (key.isNull() | (key == ""), lab.LABEL_NO_AGREEMENT),
        ((led_t < crm_t) & F.col("late"), lab.LABEL_LATE_MOVEOUT),
        ((led_t == 0) & (crm_t == 1) & F.col("same_day"), lab.LABEL_SAME_TIME),
        ((led_t == -1) & (crm_t == 0) & F.col("legacy"), lab.LABEL_OLD_HD),
        (F.col("reused"), lab.LABEL_REUSE),
    ]
    return lab.label_gaps(g, rules).drop("late", "same_day", "legacy", "reused")


def row_level_with_reuse(labelled: DataFrame, reuse_records: DataFrame, start, end) -> DataFrame:
    """The full output of the row-level run (D12): labelled gap rows with the
    window's reuse records of the same contract and company; gap rows without
    one stay."""
    rr = reuse_records.where(half_open("created_at", start, end)).withColumnRenamed("created_at", "reuse_created_at")
    return rec.enrich_gaps(labelled, rr, [("contract_uuid", "membership_agreement_uuid"), ("account_uuid", "company_uuid")],
                           salt_by=["reuse_created_at"])

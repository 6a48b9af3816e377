"""Attribution key, contract resolution and agreement lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import half_open, period, period_in_range

IN_ACTIONS = ("Move In", "Transfer In")
OUT_ACTIONS = ("Move Out", "Transfer Out")


def attribution_key(kind_pred: Column, country: Column, excluded: Sequence[str],
                    a: Column, b: Column, null_country: str = "b") -> Column:
    """``a`` for rows of the special kind outside the excluded countries,
    else ``b`` (D3, P13).

    A null country fails the ``NOT IN`` test, so it gets ``b`` unless
    ``null_country='a'`` (the CRM side of the source adds ``or country is
    null``).
    """
    outside = ~country.isin(list(excluded))
    if null_country == "a":
        outside = outside | country.isNull()
    return F.when(kind_pred & outside, a).otherwise(b)


def request_choices(requests: DataFrame, start=None, end=None) -> DataFrame:
    """(reservation_id, side, agreement_id): per reservation the agreement of
    the latest request executed near the window that set a start date (side
    ``in``) and of the latest that set an end date (``out``); of requests
    executed at one time the larger agreement id.

    The window widens the run window by one day on each side (B3). At most one
    row per reservation and side, however many requests and agreements it has,
    so the join below neither repeats a ledger row nor counts it twice.
    """
    lo = None if start is None else F.date_sub(F.lit(str(start)).cast("date"), 1)
    hi = None if end is None else F.date_add(F.lit(str(end)).cast("date"), 1)
    r = requests
    if lo is not None:
        r = r.where(F.col("executed_at") >= lo.cast("timestamp_ntz"))
    if hi is not None:
        r = r.where(F.col("executed_at") < hi.cast("timestamp_ntz"))
    return _latest(r, ["reservation_id"])


def _latest(requests: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, agreement_id) of the latest request of each side."""
    latest = F.struct("executed_at", "agreement_id")
    per = requests.groupBy(*keys).agg(
        F.max(F.when(F.col("started_on").isNotNull(), latest)).alias("in"),
        F.max(F.when(F.col("ended_on").isNotNull(), latest)).alias("out"))
    sides = F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"{s}.agreement_id").alias("agreement_id"))
                                for s in ("in", "out")]))
    return per.select(*keys, sides.alias("c")).select(
        *keys, "c.side", "c.agreement_id").where(F.col("agreement_id").isNotNull())


def request_choices_per_period(requests: DataFrame, unit: str = "month") -> DataFrame:
    """(reservation_id, period, side, agreement_id): ``request_choices`` for the
    window of every period at once. A window is a day wider than its period on
    both sides, so windows overlap: a request is placed in the periods of its
    day, of the day before and of the day after, at most three rows."""
    day = F.expr("INTERVAL '1' DAY")
    at = F.col("executed_at")
    periods = F.array_distinct(F.array(*[period(t, unit) for t in (at - day, at, at + day)]))
    placed = requests.where(at.isNotNull()).withColumn("period", F.explode(periods))
    return _latest(placed, ["reservation_id", "period"])


def resolve_contracts(ledger: DataFrame, requests: DataFrame, agreements: DataFrame,
                      start=None, end=None) -> DataFrame:
    """Each ledger row with the agreement it belongs to.

    reservation -> the latest request executed near the window -> agreement.
    Moves in need a request with a start date, moves out one with an end date.
    Rows that resolve to nothing keep a null ``agreement_uuid``; no row is
    repeated. ``start``/``end`` also bound the ledger rows (half open), when
    given.

    Every join here is on the reservation (= order) key, the key the ledger
    is already partitioned by after its own join, so Spark keeps one
    partitioning across the chain.
    """
    v = ledger
    if start is not None or end is not None:
        v = v.where(half_open("date_reserved", start, end))
    # The agreement uuid is attached to the (small) choice table first, so the
    # ledger is joined once, on the reservation key it is already partitioned
    # by, instead of being shuffled again by agreement id.
    ma = agreements.select("agreement_id", "agreement_uuid")
    choices = request_choices(requests, start, end).join(ma, "agreement_id", "left").alias("cr")
    v = v.alias("v")
    is_in = F.col("v.action_type").isin(*IN_ACTIONS)
    is_out = F.col("v.action_type").isin(*OUT_ACTIONS)
    cond = (F.col("v.reservation_id") == F.col("cr.reservation_id")) & (
        (is_in & (F.col("cr.side") == "in")) | (is_out & (F.col("cr.side") == "out")))
    return v.join(choices, cond, "left").select("v.*", F.col("cr.agreement_uuid"))


def resolve_contracts_per_period(ledger: DataFrame, requests: DataFrame, agreements: DataFrame,
                                 unit: str = "month") -> DataFrame:
    """``resolve_contracts`` run for every period as its window, in one pass:
    each ledger row with its period and the agreement that the run for that
    period would give it (D9, F14).

    The choices are unique per reservation, period and side, so no row is
    repeated and a hot reservation's rows can be split on the ledger side.
    Rows without a reservation or date are kept and resolve to nothing.
    """
    ma = agreements.select("agreement_id", "agreement_uuid")
    choices = request_choices_per_period(requests, unit).join(ma, "agreement_id", "left").drop("agreement_id").alias("cr")
    side = F.when(F.col("action_type").isin(*IN_ACTIONS), "in").when(F.col("action_type").isin(*OUT_ACTIONS), "out")
    v = ledger.withColumns({"period": period("date_reserved", unit), "__side": side}).alias("v")
    cond = ((F.col("v.reservation_id") == F.col("cr.reservation_id")) & (F.col("v.period") == F.col("cr.period"))
            & (F.col("v.__side") == F.col("cr.side")))
    return v.join(choices, cond, "left").select("v.*", F.col("cr.agreement_uuid")).drop("__side")


def agreement_lineage(requests: DataFrame, agreements: DataFrame, reservations: DataFrame,
                      unit: str = "month", start=None, end=None,
                      reservation_type: str = "PrimaryReservation") -> DataFrame:
    """Requests, agreements and reservations full-joined, primary requests
    only, agreement created in the window (D10, J7).

    The window and the primary test reject nulls from the request and
    agreement sides, so Catalyst rewrites the full joins into an inner and a
    left join. Without a window every agreement with a creation time counts.
    """
    cr = requests.alias("cr")
    ma = agreements.alias("ma")
    r = reservations.alias("r")
    j = (cr.join(ma, F.col("ma.agreement_id") == F.col("cr.agreement_id"), "full")
           .join(r, F.col("r.reservation_id") == F.col("cr.resource_id"), "full"))
    created = F.col("ma.created_at")
    in_window = created.isNotNull() & period_in_range(created, unit, start, end)
    return j.where(in_window & (F.col("cr.reservation_type") == reservation_type)).select(
        F.col("cr.account_id").alias("account_id") if "account_id" in requests.columns
        else F.col("ma.account_id").alias("account_id"),
        F.col("ma.created_at").alias("ma_created"),
        F.col("cr.created_at").alias("cr_created"),
        F.col("r.reservation_id").alias("reservation_id"),
        F.col("ma.agreement_uuid").alias("ma_uuid"),
        F.col("ma.signed_at").alias("signed_at"),
        F.col("cr.started_on").alias("started_on"),
        F.col("cr.ended_on").alias("ended_on"),
        F.col("r.reservable").alias("reservable"),
    )

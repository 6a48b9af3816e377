"""Net-sales report by period and geographic level (D4, D4a-D4d).

Plan shape: ledger rows -> join location (dimension) -> left join the
net-zero table on (reservation, period) -> one grouped aggregate. The
net-zero table is itself aggregated to (reservation, period) before the join,
so a ledger row meets at most one net-zero row (B17) and the join cannot fan
out. The joint-venture filter is null-rejecting on the location side, so
Catalyst turns that left join into an inner join and pushes the filter into
the location scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_diff, month_diff, period, period_in_range

# The selectable levels, finest first. A location column is
# shown at its own level and every finer one, null at coarser levels.
LEVELS = ["Location", "City", "Market", "Territory", "Region", "Global"]
# column -> the coarsest level at which it is still shown
COLUMN_GRAIN = {
    "location_name": "Location",
    "location_id": "Location",
    "opened_on": "Location",
    "month_no": "Location",
    "building_short_code": "Location",
    "city": "City",
    "market": "Market",
    "territory": "Territory",
    "region": "Region",
}
SELECTION = {"Location": "location_name", "City": "city", "Market": "market",
             "Territory": "territory", "Region": "region"}
TRANSFER_SUFFIX = "%transfer"


def _level(level: str) -> str:
    for lv in LEVELS:
        if lv.lower() == level.lower():
            return lv
    raise ValueError(f"level must be one of {LEVELS}")


def shown(column: str, level: str) -> bool:
    return LEVELS.index(_level(level)) <= LEVELS.index(COLUMN_GRAIN[column])


def net_zero(unit: str = "month", min_days: int = 27) -> Column:
    """Is a fact row a net-zero transfer?"""
    return ((period("sold_at", unit) == period("gave_notice", unit))
            & F.col("move_in_type").ilike(TRANSFER_SUFFIX)
            & F.col("move_out_type").ilike(TRANSFER_SUFFIX)
            & (day_diff("date_started", "date_ended") >= min_days))


def net_zero_transfers(facts: DataFrame, unit: str = "month", min_days: int = 27, start=None, end=None) -> DataFrame:
    """Reservations sold and given notice in the same period, both moves of
    transfer type, lasting at least ``min_days`` (D4c). One row per
    (reservation, period): capacity as upgrade, and negated as downgrade. A
    window on the period is applied to the raw sale date, as in the ledger."""
    if start is not None or end is not None:
        facts = facts.where(period_in_range("sold_at", unit, start, end))
    return facts.where(net_zero(unit, min_days)).groupBy(F.col("reservation_id"), period("sold_at", unit).alias("period")).agg(
        F.sum("real_capacity").alias("net_zero_upgrades"),
        (-F.sum("real_capacity")).alias("net_zero_downgrades"))


def listagg_distinct(c, sep: str = ", ") -> F.Column:
    """``listagg(DISTINCT c, sep)`` in value order; null when no value.

    A set per group (partial-aggregated map side), sorted, then joined; the
    set holds distinct values only, so it is bounded by the dimension."""
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 0, F.array_join(s, sep))


def net_sales_detail(ledger: DataFrame, locations: DataFrame, facts: DataFrame,
                     unit: str = "month", level: str = "Global", include_jv: bool = False,
                     start=None, end=None, transfer_lists: bool = True) -> DataFrame:
    """Per (period, account, level columns): upgrades, downgrades, new sales,
    churn notice, last physical-move month and transfer location lists
    (without the lists unless ``transfer_lists``).

    The sums are one hash aggregate. The lists come from the distinct
    (group, direction, location) rows of the transfers alone, joined back on
    the group: a set buffer beside the sums would make the whole aggregate an
    object aggregate.

    ``start``/``end`` bound the period (half open); applied on the raw
    ledger date so the reader skips row groups (R1).
    """
    lv = _level(level)
    v = ledger
    if start is not None or end is not None:
        v = v.where(period_in_range("date_reserved", unit, start, end))
    v = v.withColumn("period", period("date_reserved", unit)).alias("v")
    t = locations.alias("t")
    nz = net_zero_transfers(facts, unit, start=start, end=end).alias("nz")
    act = F.col("v.action_type")
    # Net-zero rows first, keyed by the reservation alone: the ledger is
    # still partitioned by it from its own join, so this join moves only the
    # (small) net-zero table. The period is a residual test; a reservation
    # has at most one net-zero row per period.
    j = v.join(nz, (F.col("v.reservation_id") == F.col("nz.reservation_id"))
               & (F.datediff(F.col("v.period"), F.col("nz.period")) == 0)
               & act.isin("Transfer In", "Transfer Out"), "left")
    j = j.join(t, F.col("v.location_id") == F.col("t.location_id"), "left")
    if not include_jv:
        j = j.where(~F.col("t.is_joint_venture"))

    loc_cols = {
        "location_name": F.col("t.location_name"),
        "location_id": F.col("t.location_id"),
        "opened_on": F.col("t.opened_on"),
        "month_no": month_diff(F.col("t.opened_on"), F.col("v.date_reserved")).cast("bigint"),
        "building_short_code": F.col("t.code"),
        "city": F.col("t.city"),
        "market": F.col("t.market"),
        "territory": F.col("t.territory"),
        "region": F.col("t.region"),
    }
    nulls = {"location_name": "string", "location_id": "bigint", "opened_on": "date", "month_no": "bigint",
             "building_short_code": "string", "city": "string", "market": "string",
             "territory": "string", "region": "string"}
    # Group only by what varies; constant and hidden-level columns are added
    # after the aggregate, so the output stays partitioned by the real keys
    # (period, account[, location columns]) and a re-aggregation by
    # (account, period) needs no new shuffle.
    shown_cols = [c for c in COLUMN_GRAIN if shown(c, lv)]
    keys = [F.col("v.period").alias("period"), F.col("v.account_id").alias("account_id")] + [
        loc_cols[c].alias(c) for c in shown_cols]
    j = j.select(*keys, F.col("v.desks_changed").alias("desks"), act.alias("action_type"),
                 F.col("v.transfer_type").alias("transfer_type"),
                 F.col("v.date_physical_move").alias("date_physical_move"),
                 F.col("t.location_name").alias("t_location_name"),
                 F.when(act == "Transfer In", F.col("nz.net_zero_upgrades")).alias("nz_up"),
                 F.when(act == "Transfer Out", F.col("nz.net_zero_downgrades")).alias("nz_down"))
    desks = F.col("desks")
    act = F.col("action_type")
    transfer = F.sum(F.when(F.col("transfer_type").isNotNull(), desks).otherwise(0))
    nz_up = F.sum(F.coalesce(F.col("nz_up"), F.lit(0)))
    nz_down = F.sum(F.coalesce(F.col("nz_down"), F.lit(0)))
    out = j.groupBy("period", "account_id", *shown_cols).agg(
        F.when(transfer > 0, transfer + nz_up).otherwise(nz_up).alias("upgrades"),
        F.when(transfer < 0, transfer + nz_down).otherwise(nz_down).alias("downgrades"),
        F.sum(F.when(act == "Move In", desks).otherwise(0)).alias("new_sales"),
        F.sum(F.when(act == "Move Out", desks).otherwise(0)).alias("churn_notice"),
        F.trunc(F.to_date(F.max(F.when(desks > 0, F.col("date_physical_move")))), "month")
         .alias("last_date_physical_move"),
    )
    if transfer_lists:
        out = _with_transfer_lists(out, j, ["period", "account_id", *shown_cols])
    sel = F.lit("Global") if lv == "Global" else F.col(SELECTION[lv])
    return out.select(
        F.lit(unit).alias("time_grouping"),
        F.lit("yes" if include_jv else "no").alias("include_jv_markets"),
        F.lit(lv).alias("select_grouping"),
        "period", "account_id", sel.alias("user_selection"),
        *[(F.col(c) if c in shown_cols else F.lit(None).cast(nulls[c])).alias(c) for c in COLUMN_GRAIN],
        "upgrades", "downgrades", "new_sales", "churn_notice", "last_date_physical_move",
        *(["transfer_out_locations", "transfer_in_locations"] if transfer_lists else []),
    )


def _with_transfer_lists(sums: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The names of the locations that each group transferred out of and into."""
    named = (rows.where(F.col("action_type").isin("Transfer In", "Transfer Out") & F.col("t_location_name").isNotNull())
             .select(*keys, "action_type", "t_location_name").distinct())
    lists = named.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        *[listagg_distinct(F.when(F.col("action_type") == a, F.col("t_location_name"))).alias(n)
          for a, n in (("Transfer Out", "transfer_out_locations"), ("Transfer In", "transfer_in_locations"))])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__{k}"))
        cond = c if cond is None else cond & c
    return sums.join(lists, cond, "left").drop(*[f"__{k}" for k in keys])


def net_sales_report(detail: DataFrame, accounts: DataFrame) -> DataFrame:
    """Final report: net sales (upgrades + new sales) per account and period
    (D4). The account name comes from the dimension after aggregation, so the
    dimension joins the small result, not the ledger rows."""
    rep = detail.groupBy("account_id", "period").agg(
        F.coalesce(F.sum(F.col("upgrades") + F.col("new_sales")), F.lit(0)).alias("net_sales"))
    names = accounts.select("account_id", "account_name")
    return rep.join(names, "account_id", "left").select(
        "account_name", "account_id", F.col("period").alias("close_date"), "net_sales")


def ledger_moves(ledger: DataFrame, facts: DataFrame, unit: str = "month") -> DataFrame:
    """Ledger rows and net-zero facts in one set of rows, for
    ``net_sales_levels``, where the two are tables of their own."""
    return ledger.select(*ledger_move()).unionByName(
        facts.where(net_zero(unit)).select(*net_zero_move()))


def ledger_move() -> list[Column]:
    """A ledger row as a move."""
    return [F.col("reservation_id"), F.col("account_id"), F.col("location_id"), F.col("date_reserved").alias("moved_at"),
            F.col("action_type"), F.col("transfer_type"), F.col("desks_changed"), F.col("date_physical_move"),
            F.lit(None).cast("bigint").alias("net_zero_capacity")]


def net_zero_move() -> list[Column]:
    """A fact row that ``net_zero`` accepts as a move: its capacity alone."""
    return [F.col("reservation_id"), F.lit(None).cast("bigint").alias("account_id"),
            F.lit(None).cast("bigint").alias("location_id"), F.col("sold_at").alias("moved_at"),
            F.lit(None).cast("string").alias("action_type"), F.lit(None).cast("string").alias("transfer_type"),
            F.lit(None).cast("bigint").alias("desks_changed"), F.lit(None).cast("timestamp_ntz").alias("date_physical_move"),
            F.coalesce(F.col("real_capacity"), F.lit(0)).alias("net_zero_capacity")]


def net_sales_levels(moves: DataFrame, locations: DataFrame, unit: str = "month", include_jv: bool = False,
                     start=None, end=None) -> DataFrame:
    """``net_sales_detail`` at all six levels at once, in one reading of the
    ledger; ``moves`` comes from ``ledger_moves`` or a view that builds it from
    one table.

    Three steps, each on fewer rows than the one before. Moves are summed per
    reservation, period, account and location, where a reservation's net-zero
    capacity meets its transfers: a window over these sums, whose groups are
    bounded by a reservation's accounts and locations however many moves it has.
    They are summed again without the reservation and meet their location.
    These sums are dealt by account and period, which all levels share, and each
    task sums its own at every level: nothing is shuffled once per level. What
    depends on a sum's sign is decided last, at each level for itself, as a
    level's sum may have another sign than its parts.

    Rows of no account or location are ledger rows like any other; a null
    reservation has no net-zero capacity.
    """
    v = moves
    if start is not None or end is not None:
        v = v.where(period_in_range("moved_at", unit, start, end))
    act, desks = F.col("action_type"), F.col("desks_changed")

    def total(cond, value):
        return F.sum(F.when(cond, value).otherwise(0))

    grain = ["period", "move_month", "account_id", "location_id"]
    is_fact = F.col("net_zero_capacity").isNotNull()
    sums = v.withColumns({"period": period("moved_at", unit), "move_month": period("moved_at", "month")}).groupBy(
        "reservation_id", *grain, is_fact.alias("is_fact")).agg(
        total(F.col("transfer_type").isNotNull(), desks).alias("transfer"),
        total(act == "Transfer In", F.lit(1)).alias("n_in"),
        total(act == "Transfer Out", F.lit(1)).alias("n_out"),
        total(act == "Move In", desks).alias("new_sales"),
        total(act == "Move Out", desks).alias("churn_notice"),
        F.max(F.when(desks > 0, F.col("date_physical_move"))).alias("last_move"),
        F.sum("net_zero_capacity").alias("capacity"))
    # Moves without a reservation are spread by their own keys: as one group of
    # nulls they would meet in one task.
    alone = F.when(F.col("reservation_id").isNull(), F.xxhash64(*grain))
    capacity = F.sum("capacity").over(Window.partitionBy("reservation_id", "period", alone))
    sums = sums.withColumn("capacity", F.when(F.col("reservation_id").isNotNull(), F.coalesce(capacity, F.lit(0))).otherwise(0))
    at_location = sums.where(~F.col("is_fact")).groupBy(*grain).agg(
        *[F.sum(c).alias(c) for c in ("transfer", "n_in", "n_out", "new_sales", "churn_notice")],
        F.max("last_move").alias("last_move"),
        F.sum(F.col("n_in") * F.col("capacity")).alias("nz_up"),
        F.sum(-F.col("n_out") * F.col("capacity")).alias("nz_down"))

    t = locations.select("location_id", "location_name", "opened_on", F.col("code").alias("building_short_code"),
                         "city", "market", "territory", "region", "is_joint_venture").withColumnRenamed("location_id", "t_id")
    j = at_location.join(t, F.col("location_id") == F.col("t_id"), "left")
    if not include_jv:
        j = j.where(~F.col("is_joint_venture"))
    j = j.select("period", "account_id", "location_name", F.col("t_id").alias("location_id"), "opened_on",
                 month_diff("opened_on", "move_month").cast("bigint").alias("month_no"), "building_short_code",
                 "city", "market", "territory", "region", "transfer", "n_in", "n_out", "new_sales", "churn_notice",
                 "last_move", "nz_up", "nz_down")
    keys = ["period", "account_id"]
    # All levels of an account and period lie in one partition: the rows are
    # dealt once, with their finest columns, and repeated per level after it.
    # A partition grows by the levels there, so there are as many times more.
    parts = len(LEVELS) * int(moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    j = (j.repartition(parts, *keys).withColumn("moved_at_location", F.col("location_name"))
         .withColumn("level", F.explode(F.array(*map(F.lit, range(len(LEVELS)))))))
    j = j.withColumns({c: F.when(F.col("level") <= LEVELS.index(grain), F.col(c)) for c, grain in COLUMN_GRAIN.items()})
    transfer, up, down = F.sum("transfer"), F.sum("nz_up"), F.sum("nz_down")
    out = j.groupBy(*keys, "level", *COLUMN_GRAIN).agg(
        F.when(transfer > 0, transfer + up).otherwise(up).alias("upgrades"),
        F.when(transfer < 0, transfer + down).otherwise(down).alias("downgrades"),
        F.sum("new_sales").alias("new_sales"), F.sum("churn_notice").alias("churn_notice"),
        F.trunc(F.to_date(F.max("last_move")), "month").alias("last_date_physical_move"),
        listagg_distinct(F.when(F.col("n_out") > 0, F.col("moved_at_location"))).alias("transfer_out_locations"),
        listagg_distinct(F.when(F.col("n_in") > 0, F.col("moved_at_location"))).alias("transfer_in_locations"))
    out = out.withColumn("select_grouping", F.element_at(F.array(*map(F.lit, LEVELS)), F.col("level") + 1))
    selection = F.lit("Global")
    for lv, c in SELECTION.items():
        selection = F.when(F.col("select_grouping") == lv, F.col(c)).otherwise(selection)
    return out.select(
        F.lit(unit).alias("time_grouping"), F.lit("yes" if include_jv else "no").alias("include_jv_markets"),
        "select_grouping", "period", "account_id", selection.alias("user_selection"), *COLUMN_GRAIN,
        "upgrades", "downgrades", "new_sales", "churn_notice", "last_date_physical_move",
        "transfer_out_locations", "transfer_in_locations")

"""Business roles mapped onto the test tables (FIXTURES.md section 3).

Every view is a lazy projection of the parquet tables, so the columns a query
does not use are pruned from the scan and its filters reach the reader.
Dimension joins (nation, region: 25 and 5 rows) are tiny and fixed-size;
everything else is left to Catalyst and AQE to plan by measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import netsales as ns
from .tables import read_table

# Stage names and ledger action names as the source systems
# spell them.
WON = "Closed Won"
LOST = "Closed Lost"
OPEN = "Open"
MOVE_IN = "Move In"
MOVE_OUT = "Move Out"
TRANSFER_IN = "Transfer In"
TRANSFER_OUT = "Transfer Out"
HOT_DESK_LEDGER = "HotDesk"
PRIMARY = "PrimaryReservation"

# Analogue choices (not reference values): which order priority plays the
# hot-desk product, and the eight nations playing the excluded countries.
HOT_DESK_PRIORITY = "1-URGENT"
EXCLUDED_NATIONS = ["NATION_1", "NATION_4", "NATION_7", "NATION_10",
                    "NATION_13", "NATION_16", "NATION_19", "NATION_22"]


def opportunities(spark: SparkSession, base: str) -> DataFrame:
    """CRM opportunities: one per order.

    desks = floor(totalprice / 10000); ``total_desks_net`` is negative for
    lost deals. Reservation key = the account, contract key = the order; both
    as text so the two key spaces never collide.
    """
    o = read_table(spark, base, "orders")
    desks = F.floor(F.col("o_totalprice") / 10000).cast("bigint")
    stage = (F.when(F.col("o_orderstatus") == "F", F.lit(WON))
              .when(F.col("o_orderstatus") == "O", F.lit(LOST))
              .otherwise(F.lit(OPEN)))
    return o.select(
        F.col("o_orderkey").alias("opp_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderdate").alias("created_date"),
        F.col("o_orderdate").alias("close_date"),
        F.col("o_orderstatus").alias("status_code"),
        stage.alias("stage_name"),
        F.col("o_orderpriority").alias("type_c"),
        desks.alias("desks"),
        F.when(F.col("o_orderstatus") == "O", -desks).otherwise(desks).alias("total_desks_net"),
        F.concat(F.lit("R-"), F.col("o_custkey").cast("string")).alias("reservation_key"),
        F.concat(F.lit("C-"), F.col("o_orderkey").cast("string")).alias("contract_key"),
    )


def ledger(spark: SparkSession, base: str) -> DataFrame:
    """Transaction ledger: one movement per line item, signed by action.

    N = Move In (+q), R = Move Out (-q), A = transfer: in (+q) when the line
    status is F, out (-q) when O. The account comes from the order (a
    shuffle join on the order key; lineitem and orders both grow with data).
    """
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders").select(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority"))
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(*_ledger_columns())


def _ledger_columns() -> list[Column]:
    q = F.col("l_quantity").cast("bigint")
    action = (F.when(F.col("l_returnflag") == "N", F.lit(MOVE_IN))
               .when(F.col("l_returnflag") == "R", F.lit(MOVE_OUT))
               .when(F.col("l_linestatus") == "F", F.lit(TRANSFER_IN))
               .otherwise(F.lit(TRANSFER_OUT)))
    sign = F.when(action.isin(MOVE_IN, TRANSFER_IN), F.lit(1)).otherwise(F.lit(-1))
    return [
        F.col("o_custkey").alias("account_id"),
        F.col("l_orderkey").alias("reservation_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("location_id"),
        action.alias("action_type"),
        F.when(F.col("l_returnflag") == "A", F.lit("Transfer")).alias("transfer_type"),
        (q * sign).cast("bigint").alias("desks_changed"),
        F.col("l_shipdate").alias("date_reserved"),
        F.col("l_shipdate").alias("date_physical_move"),
        F.when(F.col("o_orderpriority") == HOT_DESK_PRIORITY, F.lit(HOT_DESK_LEDGER))
         .otherwise(F.lit("Office")).alias("reservable_type"),
    ]


def nations(spark: SparkSession, base: str) -> DataFrame:
    """Nation x region, 25 rows: a fixed-size dimension, safe to broadcast."""
    n = read_table(spark, base, "nation")
    r = read_table(spark, base, "region")
    return n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")


def countries(spark: SparkSession, base: str) -> DataFrame:
    """country_key -> country name (25 rows)."""
    return read_table(spark, base, "nation").select(
        F.col("n_nationkey").alias("country_key"), F.col("n_name").alias("country"))


def locations(spark: SparkSession, base: str) -> DataFrame:
    """Location dimension: supplier x nation x region.

    Location = supplier, market = nation, region = region; a market has three
    cities, by the supplier's key, and a region two territories, by the nation's.
    Joint venture = supplier with a negative balance. A location
    opens on the first of (1994-01 + nation key) months.
    """
    s = read_table(spark, base, "supplier")
    nr = nations(spark, base)
    return s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey).select(
        F.col("s_suppkey").alias("location_id"),
        F.col("s_name").alias("location_name"),
        F.concat(F.col("n_name"), F.lit("/"), (F.col("s_suppkey") % 3).cast("string")).alias("city"),
        F.col("n_name").alias("market"),
        F.concat(F.col("r_name"), F.lit("/"), (F.col("n_nationkey") % 2).cast("string")).alias("territory"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("country_key"),
        F.concat(F.lit("L"), F.col("s_suppkey").cast("string")).alias("code"),
        F.add_months(F.lit("1994-01-01").cast("date"), F.col("n_nationkey")).alias("opened_on"),
        (F.col("s_acctbal") < 0).alias("is_joint_venture"),
    )


def accounts(spark: SparkSession, base: str) -> DataFrame:
    """Account dimension with home country: customer x nation."""
    c = read_table(spark, base, "customer")
    nr = nations(spark, base)
    return c.join(F.broadcast(nr), c.c_nationkey == nr.n_nationkey).select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("account_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.col("n_nationkey").alias("country_key"),
    )


def reservation_facts(spark: SparkSession, base: str) -> DataFrame:
    """One fact row per line item of an order (several per reservation).

    Sold on the order date, notice given on the ship date, ended up to 59 days
    after it (by the part's key); move-in type is a transfer for returnflag A,
    move-out type a transfer for line status O.
    """
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(F.col("l_orderkey").alias("reservation_id"), *_fact_columns())


def _fact_columns() -> list[Column]:
    return [
        F.col("o_orderdate").alias("sold_at"),
        F.col("l_shipdate").alias("gave_notice"),
        F.when(F.col("l_returnflag") == "A", F.lit("Desk Transfer")).otherwise(F.lit("New")).alias("move_in_type"),
        F.when(F.col("l_linestatus") == "O", F.lit("Office TRANSFER")).otherwise(F.lit("Churn")).alias("move_out_type"),
        F.to_date("o_orderdate").alias("date_started"),
        F.date_add(F.to_date("l_shipdate"), (F.col("l_partkey") % 60).cast("int")).alias("date_ended"),
        F.col("l_quantity").cast("bigint").alias("real_capacity"),
    ]


def moves(spark: SparkSession, base: str, unit: str = "month") -> DataFrame:
    """Ledger rows and net-zero facts as moves (``netsales.ledger_moves``). Both
    roles are played by lineitem, so one reading serves them: each line becomes
    its ledger row and, where it is a net-zero transfer, its fact row."""
    li = read_table(spark, base, "lineitem")
    o = read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    both = li.join(o, li.l_orderkey == o.o_orderkey).select(*_ledger_columns(), *_fact_columns())
    # The reservation stays a column of its own, beside the roles: the rows are
    # still known to be dealt by it, so what is summed by it needs no shuffle.
    ledger_row, fact_row = (F.struct(*columns[1:]) for columns in (ns.ledger_move(), ns.net_zero_move()))
    roles = F.array(ledger_row, F.when(ns.net_zero(unit), fact_row))
    return (both.select("reservation_id", F.explode(roles).alias("move")).where(F.col("move").isNotNull())
            .select("reservation_id", "move.*"))


def change_requests(spark: SparkSession, base: str) -> DataFrame:
    """Change requests: one per line item; reservation and agreement are the
    order. Line 1 is the primary reservation. Started when the line is
    F-status, ended when returned (R)."""
    li = read_table(spark, base, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("reservation_id"),
        F.col("l_orderkey").alias("agreement_id"),
        F.col("l_partkey").alias("resource_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("executed_at"),
        F.col("l_shipdate").alias("created_at"),
        F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("started_on"),
        F.when(F.col("l_returnflag") == "R", F.to_date("l_shipdate")).alias("ended_on"),
        F.when(F.col("l_linenumber") == 1, F.lit(PRIMARY)).otherwise(F.lit("Secondary")).alias("reservation_type"),
    )


def agreements(spark: SparkSession, base: str) -> DataFrame:
    """Membership agreements: one per order; signed when status is F."""
    o = read_table(spark, base, "orders")
    return o.select(
        F.col("o_orderkey").alias("agreement_id"),
        F.concat(F.lit("C-"), F.col("o_orderkey").cast("string")).alias("agreement_uuid"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("signed_at"),
    )


def reuse_records(spark: SparkSession, base: str) -> DataFrame:
    """Opportunity reuse records built from events.

    company = user, agreement = 'C-' || event id. The CRM response names a new
    opportunity for signups, an update of the user's own opportunity for
    views, of the next user's for clicks, and both a new and an update for
    every second other event. An opportunity was found by us
    when the event value is at least 50.
    """
    e = read_table(spark, base, "events")
    own = F.concat(F.lit("OPP-"), F.col("user_id").cast("string"))
    nxt = F.concat(F.lit("OPP-"), (F.col("user_id") + 1).cast("string"))
    resp = (F.when(F.col("event_type") == "signup", F.concat(F.lit("New Opportunity : "), own))
             .when(F.col("event_type") == "view", F.concat(F.lit("Update Opportunity : "), own))
             .when(F.col("event_type") == "click", F.concat(F.lit("Update Opportunity : "), nxt))
             .when(F.col("event_id") % 2 == 0, F.concat(
                 F.lit("New Opportunity : OPP-"), (F.col("user_id") + 2).cast("string"),
                 F.lit("; Update Opportunity : "), nxt))
             .otherwise(F.lit("No Action")))
    return e.select(
        F.col("event_id").alias("record_id"),
        F.col("user_id").alias("company_id"),
        F.concat(F.lit("C-"), F.col("event_id").cast("string")).alias("agreement_uuid"),
        F.col("event_type").alias("contract_event_type"),
        F.col("props").alias("contract_event_params"),
        resp.alias("crm_response"),
        F.when(F.col("value") >= 50, own).alias("opportunity_id_found"),
        F.col("ts").alias("created_at"),
    )


def exception_log_lines(spark: SparkSession, base: str) -> DataFrame:
    """Exception log lines derived from events (FIXTURES.md): the first
    'retry' sits inside the exception slice, the second after it."""
    e = read_table(spark, base, "events")
    eid = F.col("event_id").cast("string")
    return e.select(F.concat(
        F.lit("ts="), eid, F.lit(" exception "), F.col("event_type"),
        F.when(F.col("event_id") % 3 == 0, F.lit(" retry")).otherwise(F.lit("")),
        F.lit(" "), F.col("props"), F.lit(" records: "), F.col("user_id").cast("string"),
        F.when(F.col("event_id") % 5 == 0, F.lit(" retry")).otherwise(F.lit("")),
        F.lit(" id: "), eid,
    ).alias("value"))


def failed_event_log_lines(spark: SparkSession, base: str) -> DataFrame:
    """'Failed sending Contract event' log lines derived from events
    (FIXTURES.md)."""
    e = read_table(spark, base, "events")
    return e.select(F.concat(
        F.lit('t Failed sending Contract event to SF with {"event_name"=>"'), F.col("event_type"),
        F.lit('", "company_uuid"=>"'), F.lpad(F.col("user_id").cast("string"), 36, "0"),
        F.lit('", "membership_agreement_uuid"=>"'), F.lpad(F.col("event_id").cast("string"), 36, "0"),
        F.lit('"} exception '), F.col("props"),
        F.when(F.col("event_id") % 5 == 0, F.lit(" retry")).otherwise(F.lit("")),
    ).alias("value"))

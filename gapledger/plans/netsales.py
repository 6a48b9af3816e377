"""Net-sales plans (D4) over the analogue views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import netsales as ns
from ..operators import ordering as od
from ..sources import analogues as av


# A window that starts and ends within a month (an analogue choice).
WINDOW_START, WINDOW_END = "1995-01-10", "1996-02-10"


def detail(spark: SparkSession, base: str, level: str, unit: str = "month", **kw) -> DataFrame:
    return ns.net_sales_detail(av.ledger(spark, base), av.locations(spark, base),
                               av.reservation_facts(spark, base), unit=unit, level=level, **kw)


def _report(spark: SparkSession, base: str) -> DataFrame:
    return ns.net_sales_report(detail(spark, base, "Global", transfer_lists=False), av.accounts(spark, base))


def net_sales_global(spark: SparkSession, base: str) -> DataFrame:
    """The report the source printed: net sales per account and month,
    latest period first (ORDER BY 3 DESC), accounts in order within it, so
    that the sort has as many ranges as the cluster has tasks."""
    return od.sort_report(_report(spark, base), ("close_date", "desc"), ("account_id", "asc"))


def net_sales_with_id(spark: SparkSession, base: str) -> DataFrame:
    """The report with a consecutive surrogate id by (period, account) (W1);
    a bucket is a period and a range of 65,536 account ids."""
    return od.surrogate_id(_report(spark, base), ["close_date", "account_id"],
                           [F.col("close_date"), F.floor(F.col("account_id") / 65536)])


def net_sales_region(spark: SparkSession, base: str) -> DataFrame:
    return detail(spark, base, "Region")


def net_sales_nation(spark: SparkSession, base: str) -> DataFrame:
    return detail(spark, base, "Market")


def net_sales_location(spark: SparkSession, base: str) -> DataFrame:
    return detail(spark, base, "Location")


def net_sales_city(spark: SparkSession, base: str) -> DataFrame:
    return detail(spark, base, "City")


def net_sales_territory(spark: SparkSession, base: str) -> DataFrame:
    return detail(spark, base, "Territory")


def net_sales_jv(spark: SparkSession, base: str) -> DataFrame:
    """Joint ventures and unknown locations included."""
    return detail(spark, base, "Market", include_jv=True)


def net_sales_day(spark: SparkSession, base: str) -> DataFrame:
    """Per day instead of per month."""
    return detail(spark, base, "Global", unit="day")


def net_sales_window(spark: SparkSession, base: str) -> DataFrame:
    """Periods of a run window (P11); its filters reach both scans."""
    return detail(spark, base, "Region", start=WINDOW_START, end=WINDOW_END)


def net_sales_levels(spark: SparkSession, base: str) -> DataFrame:
    """All six levels from one reading of the ledger."""
    return ns.net_sales_levels(av.moves(spark, base), av.locations(spark, base))


def net_zero_transfers(spark: SparkSession, base: str) -> DataFrame:
    return ns.net_zero_transfers(av.reservation_facts(spark, base))


def transfer_locations(spark: SparkSession, base: str) -> DataFrame:
    """D4d: transfer-in / -out location lists and last move-in month."""
    return detail(spark, base, "Global").select(
        "period", "account_id", "transfer_in_locations", "transfer_out_locations",
        "last_date_physical_move")

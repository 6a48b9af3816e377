"""Analyst statements run as Spark SQL text over registered views (S1, A13,
P7, P26, F9): the fourth entry point of the source, SQL typed by a user.

Views are registered under a ``gl_`` prefix so they never shadow a caller's
own views; each is a lazy projection of the parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import analogues as av
from ..sources.tables import read_table


def _views(spark: SparkSession, base: str) -> None:
    av.opportunities(spark, base).createOrReplaceTempView("gl_opportunity")
    av.ledger(spark, base).createOrReplaceTempView("gl_transaction")
    read_table(spark, base, "orders").createOrReplaceTempView("gl_orders")


def month_of_year_compare(spark: SparkSession, base: str) -> DataFrame:
    """Distinct accounts per month of year in both systems (months of all
    years fall together, as date_part(month) did, B13); GROUP BY the output
    alias (A13) and a difference written with the select-list aliases (P7)."""
    _views(spark, base)
    return spark.sql("""
WITH ledger_m AS (
  SELECT CAST(date_part('MONTH', t.date_reserved) AS INT) AS month, count(DISTINCT t.account_id) AS cnt
  FROM gl_transaction t WHERE t.desks_changed > 0 GROUP BY month),
crm_m AS (
  SELECT CAST(date_part('MONTH', o.close_date) AS INT) AS month, count(DISTINCT o.account_id) AS cnt
  FROM gl_opportunity o WHERE o.stage_name = 'Closed Won' GROUP BY month)
SELECT crm_m.month, crm_m.cnt AS crm, ledger_m.cnt AS ledger, crm - ledger AS diff
FROM crm_m JOIN ledger_m ON ledger_m.month = crm_m.month""")


def execution_errors(spark: SparkSession, base: str) -> DataFrame:
    """Count of agreements with no executed request (A1, P15); ``DISTINCT``
    over a one-row aggregate is a plain count (P26)."""
    _views(spark, base)
    return spark.sql("""
SELECT DISTINCT count(e.o_orderkey) AS n
FROM gl_orders e
WHERE (CASE WHEN e.o_orderstatus = 'F' THEN 'executed' END) IS NULL""")

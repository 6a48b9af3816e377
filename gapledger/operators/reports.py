"""Ad-hoc reports (D18-D24) and statement-level helpers.

Each report is a grouped aggregate over a narrow projection; periods are
few, so per-period results are tiny and any join between them is a join of
small tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import interval_part, month_of_year, period


def _period(ts: str, unit: str, month_only: bool) -> Column:
    return month_of_year(ts) if month_only else period(ts, unit)


def funnel(stages: Mapping[str, tuple[DataFrame, str]], unit: str = "month",
           month_of_year_only: bool = False) -> DataFrame:
    """Rows per stage and period, one row per period present in every stage
    (D18; the source's chain of inner joins).

    All stages go through one union and one grouped count: a single shuffle
    of partial counts instead of one aggregate and one join per stage.
    """
    parts = [df.select(_period(ts, unit, month_of_year_only).alias("period"), F.lit(name).alias("stage"))
             for name, (df, ts) in stages.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    out = u.groupBy("period").agg(*[F.count_if(F.col("stage") == n).alias(n) for n in stages])
    cond = None
    for n in stages:
        c = F.col(n) > 0
        cond = c if cond is None else cond & c
    return out.where(cond)


def distinct_per_period(df: DataFrame, key: str, ts: str, name: str, unit: str = "month",
                        month_of_year_only: bool = False) -> DataFrame:
    return df.groupBy(_period(ts, unit, month_of_year_only).alias("period")).agg(
        F.count_distinct(key).alias(name))


def compare_counts(a: DataFrame, a_key: str, a_ts: str, b: DataFrame, b_key: str, b_ts: str,
                   names: tuple[str, str] = ("crm", "ledger"), unit: str = "month",
                   month_of_year_only: bool = False) -> DataFrame:
    """Distinct keys per period in two systems and their difference.
    Inner join on period, as the source did: a period missing on one side
    is not reported."""
    x = distinct_per_period(a, a_key, a_ts, names[0], unit, month_of_year_only)
    y = distinct_per_period(b, b_key, b_ts, names[1], unit, month_of_year_only)
    return x.join(y, "period").withColumn("diff", F.col(names[0]) - F.col(names[1]))


def share(df: DataFrame, pred: Column, ts: str, unit: str = "month", month_of_year_only: bool = False) -> DataFrame:
    """Rows per period and those matching ``pred`` (D20). Periods with no
    match are dropped, as the source's inner join did."""
    out = df.groupBy(_period(ts, unit, month_of_year_only).alias("period")).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(pred).alias("matching"))
    return out.where(F.col("matching") > 0).withColumn(
        "share_pct", F.round(F.lit(100.0) * F.col("matching") / F.col("total"), 6))


def durations(df: DataFrame, start: str, end: str, keys: Sequence[str], part: str = "DAY") -> DataFrame:
    """Mean ``part`` component of (end - start) by year, month and keys."""
    return df.groupBy(F.year(start).alias("year"), F.month(start).alias("month"), *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(interval_part(part, start, end)), 6).alias("avg_duration"))


def segment_volumes(df: DataFrame, ts: str, segment: str, type_id: str, count_col: str, measure: Column,
                    won_pred: Column, unit: str = "month", month_of_year_only: bool = False) -> DataFrame:
    """Count of deals and won measure per period and segment (D22). Segments
    are told apart by id and name: two types of one name stay two rows."""
    return df.groupBy(_period(ts, unit, month_of_year_only).alias("period"), F.col(type_id).alias("type_id"),
                      F.col(segment).alias("segment")).agg(
        F.count(count_col).alias("opps"),
        F.sum(F.when(won_pred, measure)).alias("desks_won"))


def reuse_conflicts(df: DataFrame, response: str = "crm_response", found: str = "opportunity_id_found") -> DataFrame:
    """Classify reuse records (D23): 1 = the CRM created a new opportunity
    where we found one; 2 = it updated one where we found none; 3 = both
    updated, different ids. One row per class that holds, as three separate
    statements gave; rows in no class are dropped."""
    r, f = F.col(response), F.col(found)
    new, update = r.like("%New Opportunity :%"), r.like("%Update Opportunity :%")
    kinds = F.array(F.when(new & f.isNotNull(), F.lit(1)), F.when(update & f.isNull(), F.lit(2)),
                    F.when(update & f.isNotNull() & ~F.contains(r, f), F.lit(3)))
    return df.withColumn("conflict", F.explode(F.filter(kinds, lambda k: k.isNotNull())))


def tag_effort(tags: DataFrame, pred: Column | None = None, tickets: DataFrame | None = None,
               by_month: bool = False) -> DataFrame:
    """Tickets and mean hour component of (updated - created) per tag.

    ``tags`` has (ticket_id, tag) and, when ``tickets`` is None, also
    created_at / updated_at. With a separate ticket table the two are joined
    on the ticket id first (J1).
    """
    df = tags
    if tickets is not None:
        df = tags.join(tickets, "ticket_id")
    if pred is not None:
        df = df.where(pred)
    keys = [F.col("tag")] + ([month_of_year("created_at").alias("month")] if by_month else [])
    return df.groupBy(*keys).agg(
        F.count("ticket_id").alias("n"),
        F.round(F.avg(interval_part("HOUR", "created_at", "updated_at")), 6).alias("diff"))


def in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose ``col`` is in ``values`` (P14): one IN predicate, pushed to
    the scan; Spark turns a long list into a hash set."""
    return df.where(F.col(col).isin(list(dict.fromkeys(values))))


def flag_membership(df: DataFrame, key: str, other: DataFrame, other_key: str, name: str) -> DataFrame:
    """Boolean column: does ``key`` appear in ``other`` (J15, P29). The other
    side is reduced to distinct keys first, so the left join never
    multiplies rows."""
    keys = other.select(F.col(other_key).alias(f"__{name}")).where(F.col(f"__{name}").isNotNull()).distinct()
    j = df.join(keys, F.col(key) == F.col(f"__{name}"), "left")
    return j.withColumn(name, F.col(f"__{name}").isNotNull()).drop(f"__{name}")


def keys_in_both(df: DataFrame, key: str, pred_a: Column, pred_b: Column) -> DataFrame:
    """Keys with rows matching both predicates (J14). The source joined two
    filtered copies of one table; one grouped pass with two conditional
    counts gives the same keys without the self join, and ``n_pairs`` is
    the number of rows that join would have produced for the key."""
    return (df.where(pred_a | pred_b).groupBy(key)
              .agg(F.count_if(pred_a).alias("_a"), F.count_if(pred_b).alias("_b"))
              .where((F.col("_a") > 0) & (F.col("_b") > 0))
              .select(key, (F.col("_a") * F.col("_b")).alias("n_pairs")))

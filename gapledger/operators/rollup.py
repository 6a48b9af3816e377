"""Exact distinct counts that roll up.

``count(DISTINCT id)`` of a year cannot be added up from its months. A set of
ids can: per group, period and range of 32,768 ids one bitmap (4 KB) is built
with partial aggregation, and coarser periods, or several groups together, are
the OR of finer bitmaps. One pass over the rows serves every level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import period

ALL = "all"


def id_bitmaps(rows: DataFrame, group: str, ident: str, day: str, unit: str) -> DataFrame:
    """(group, period, bucket, ids): the ids of each group and period as
    bitmaps; the table to store. Ids are whole numbers from 0; null ids are no
    ids, as in ``count(DISTINCT id)``."""
    return (rows.where(F.col(ident).isNotNull())
            .groupBy(F.col(group).alias("group"), period(day, unit).alias("period"), F.bitmap_bucket_number(ident).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(ident)).alias("ids")))


def distinct_of(bitmaps: DataFrame, unit: str) -> DataFrame:
    """(group, unit, period, n_distinct) at a coarser ``unit``, per group and
    for all groups together (``all``)."""
    each = bitmaps.withColumn("period", period("period", unit))
    both = each.unionByName(each.withColumn("group", F.lit(ALL)))
    merged = both.groupBy("group", "period", "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return merged.groupBy("group", "period").agg(F.sum(F.bitmap_count("ids")).alias("n_distinct")).select(
        "group", F.lit(unit).alias("unit"), "period", "n_distinct")


def distinct_by_period(rows: DataFrame, group: str, ident: str, day: str, units: Sequence[str]) -> DataFrame:
    """Distinct ids per group and period for each of ``units``, finest first;
    each level is merged from the one before."""
    bitmaps = id_bitmaps(rows, group, ident, day, units[0])
    out = distinct_of(bitmaps, units[0])
    for unit in units[1:]:
        bitmaps = (bitmaps.groupBy("group", period("period", unit).alias("period"), "bucket")
                   .agg(F.bitmap_or_agg("ids").alias("ids")))
        out = out.unionByName(distinct_of(bitmaps, unit))
    return out

"""Ordering and surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_report(df: DataFrame, *specs: tuple[str, str]) -> DataFrame:
    """ORDER BY with the warehouse's null placement: ascending puts nulls
    last, descending puts them first (O1, O2). Meant for small report
    results; the sort is a range-partitioned shuffle, no single task."""
    cols: list[Column] = []
    for c, direction in specs:
        cols.append(F.col(c).desc_nulls_first() if direction.lower() == "desc" else F.col(c).asc_nulls_last())
    return df.orderBy(*cols)


def surrogate_id(df: DataFrame, order: Sequence[str], buckets: Sequence[Column], name: str = "id") -> DataFrame:
    """Consecutive 1-based ids in ``order`` (W1) without a window over all rows.

    ``row_number() over (order by ...)`` with no partition runs in one task.
    Here rows fall into ``buckets``: expressions that do not decrease along
    ``order`` (a period, and an id divided by a width, say), so a row's id is
    its rank in its bucket plus the rows of the buckets before. The one
    unpartitioned window is over the bucket sizes, a row per bucket; choose
    buckets of thousands of rows. Nothing runs until an action. ``order``
    should be a unique key for the ids to be reproducible; nulls come first.
    """
    keys = [f"__b{i}" for i in range(len(buckets))]
    d = df.withColumns(dict(zip(keys, buckets)))
    before = Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
               .select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)],
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off")))
    ranked = d.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__o{i}"))
        cond = c if cond is None else cond & c
    return ranked.join(offsets, cond).select(*df.columns, (F.col("__off") + F.col("__rank")).alias(name))

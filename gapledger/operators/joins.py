"""Joins of two skewed sides.

AQE splits a skewed partition only on the side whose rows may be
duplicated: for a left outer join that is the left side. When the right
side of a left join has a hot key (one agreement holding a third of all
records), its rows all land in one task, and so do left rows without a key.
``salted_left_join`` spreads both, and deals a key that is hot on both sides
as a grid of left shares by right shares.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def salted_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]],
                     salt_by: Sequence[str], rows_per_salt: int = 100_000,
                     left_salt_by: Sequence[str] | None = None) -> DataFrame:
    """``left LEFT JOIN right ON left.a = right.b AND ...`` with every right
    key spread over as many salts as its row count asks for. Same rows as the
    plain join.

    The rows of each right key are counted (partial-aggregated); a key with
    more than ``rows_per_salt`` rows gets one salt per ``rows_per_salt``, its
    right rows a salt from a hash of ``salt_by`` (columns of ``right``;
    deterministic, so a retried task sees the same salt), its left rows one
    copy per salt. Other keys, and left rows without a match, keep salt 0.
    With ``left_salt_by`` (columns of ``left``) the rows of each left key are
    counted as well: its left rows are dealt over shares by a hash of these
    columns and its right rows copied to each share, so a key that is hot on
    both sides fills a grid of tasks. Left rows that lack a key match nothing
    and are dealt by a hash of all their columns. The number of hot keys is not
    limited, and how the counts are joined is Spark's choice by size.
    """
    lcols = [lc for lc, _ in on]
    rcols = [rc for _, rc in on]

    def shares(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_salt)
        return counts.select(*[F.col(c).alias(f"__h{i}") for i, c in enumerate(cols)],
                             F.ceil(F.col("__n") / rows_per_salt).cast("int").alias(name))

    keys = [f"__h{i}" for i in range(len(on))]
    hot = shares(right.dropna(subset=rcols), rcols, "__salts")
    if left_salt_by:
        hot = hot.join(shares(left.dropna(subset=lcols), lcols, "__rows"), keys, "full")
    else:
        hot = hot.withColumn("__rows", F.lit(1))

    def dealt(df: DataFrame, cols: Sequence[str]) -> DataFrame:
        cond = None
        for c, h in zip(cols, keys, strict=True):
            x = df[c] == hot[h]
            cond = x if cond is None else cond & x
        j = df.join(hot, cond, "left")
        return j.withColumn("__salts", F.coalesce("__salts", F.lit(1))).withColumn("__rows", F.coalesce("__rows", F.lit(1))).drop(*keys)

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    r = dealt(right, rcols).withColumn("__salt", F.pmod(F.xxhash64(*salt_by), F.col("__salts")).cast("int")).drop("__salts")
    r = r.withColumn("__row", every("__rows")).drop("__rows")
    lt = dealt(left, lcols)
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in lcols])
    own = F.pmod(F.xxhash64(*(left_salt_by or [F.lit(0)])), F.col("__rows")).cast("int")
    lt = lt.withColumn("__row", F.when(lacks, F.pmod(F.xxhash64(*left.columns), F.lit(1 << 30)).cast("int")).otherwise(own))
    lt = lt.drop("__rows").withColumn("__salt", every("__salts"))
    cond = (lt["__salt"] == r["__salt"]) & (lt["__row"] == r["__row"])
    for lc, rc in on:
        cond = cond & (lt[lc] == r[rc])
    j = lt.join(r, cond, "left")
    # a hot key has right rows, so copies of its left rows that met none are no rows of the plain join
    j = j.where((lt["__salts"] == 1) | r["__salt"].isNotNull()).drop("__salts")
    return j.drop(lt["__salt"]).drop(r["__salt"]).drop(lt["__row"]).drop(r["__row"])

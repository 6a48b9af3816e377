"""Reconciliation of two sources.

Shape of the work: each side is aggregated to key grain first (map-side
partial aggregation, so a hot key costs one row per task, not one shuffle
partition full of rows), then the two key-grain tables are full-outer joined.
Keys are unique on both sides of that join, so it cannot fan out or skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def net_outcomes(
    df: DataFrame,
    key: str | Sequence[str],
    won_pred: Column,
    lost_pred: Column,
    won_measure: Column,
    lost_measure: Column,
    attrs: Sequence[str] = (),
    names: tuple[str, str, str] = ("won", "lost", "net"),
    drop_null_keys: Sequence[str] = (),
) -> DataFrame:
    """Signed net of two outcomes per key in one grouped pass.

    Rows matching neither predicate are dropped before the shuffle. ``attrs``
    are carried as their smallest value per key (deterministic). Rows whose
    ``drop_null_keys`` are null are left out, as a pandas group-by does (A12).
    """
    won, lost, net = names
    agg = [
        F.sum(F.when(won_pred, won_measure)).alias(won),
        F.sum(F.when(lost_pred, lost_measure)).alias(lost),
    ] + [F.min(a).alias(a) for a in attrs]
    cond = won_pred | lost_pred
    for k in drop_null_keys:
        cond = cond & F.col(k).isNotNull()
    out = df.where(cond).groupBy(*_cols(key)).agg(*agg)
    return out.withColumn(
        net, F.coalesce(F.col(won), F.lit(0)) + F.coalesce(F.col(lost), F.lit(0)))


def totals_by_key(df: DataFrame, key, measure: Column | str, name: str, attrs: Sequence[str] = (),
                  drop_null_keys: Sequence[str] = ()) -> DataFrame:
    """One side's total per key, with attributes carried by ``min``; rows
    with a null in ``drop_null_keys`` are left out (A12)."""
    m = F.col(measure) if isinstance(measure, str) else measure
    for k in drop_null_keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*_cols(key)).agg(F.sum(m).alias(name), *[F.min(a).alias(a) for a in attrs])


def remap_keys(df: DataFrame, key: str, key_map: DataFrame, from_col: str, to_col: str) -> DataFrame:
    """Replace ``key`` by its mapped value (J13, e.g. billing account ->
    organisation). Inner join as in the source: unmapped rows drop out. The
    map is reduced to distinct pairs; Spark/AQE broadcast it when its
    measured size allows, else shuffle-join it."""
    m = key_map.select(F.col(from_col).alias("__from"), F.col(to_col).alias("__to")).distinct()
    return df.join(m, df[key] == m["__from"]).withColumn(key, F.col("__to")).drop("__from", "__to")


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str | Sequence[str],
    left_total: str,
    right_total: str,
    attrs: Sequence[str] = (),
    prefer: str = "right",
    null_key: str = "separate",
    gaps_only: bool = True,
    names: tuple[str, str] = ("net_gap", "abs_gap"),
) -> DataFrame:
    """Full outer join of two key-grain totals, zero-filled, with gaps.

    ``left`` and ``right`` must already be at key grain (one row per key; see
    ``totals_by_key`` / ``net_outcomes``). ``null_key="separate"`` keeps
    null keys of the two sides apart (SQL); ``"match"`` joins them
    (``<=>``, the pandas-merge regime). Attributes are coalesced, ``prefer``
    side first. ``gaps_only`` keeps rows whose net gap is not zero.
    """
    keys = _cols(key)
    net_name, abs_name = names
    l = left.alias("l")
    r = right.alias("r")
    if null_key == "separate":
        conds = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    elif null_key == "match":
        conds = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    else:
        raise ValueError("null_key must be 'separate' or 'match'")
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    first, second = ("r", "l") if prefer == "right" else ("l", "r")
    lt = F.coalesce(F.col(f"l.{left_total}"), F.lit(0))
    rt = F.coalesce(F.col(f"r.{right_total}"), F.lit(0))
    out = l.join(r, cond, "full").select(
        *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
        *[F.coalesce(F.col(f"{first}.{a}"), F.col(f"{second}.{a}")).alias(a) for a in attrs],
        lt.alias(left_total),
        rt.alias(right_total),
        (lt - rt).alias(net_name),
        F.abs(lt - rt).alias(abs_name),
    )
    return out.where(F.col(net_name) != 0) if gaps_only else out


def summarize(
    recon: DataFrame,
    left_total: str,
    right_total: str,
    key: str,
    period: str | None = None,
    names: tuple[str, str] = ("net_gap", "abs_gap"),
) -> DataFrame:
    """One-row totals of a full (not gap-only) reconciliation.

    ``accounts_total`` counts distinct keys over all rows (what the source
    report printed as "affected"); ``accounts_with_gap`` only those with a
    non-zero gap (B16). Two steps: totals per key (one shuffle on the key,
    partial-aggregated), then a global merge of those per-key rows. No
    distinct-count expansion of the input, and a hot key is folded map-side.
    """
    net_name, abs_name = names
    per_key = [
        F.sum(right_total).alias("_r"), F.sum(left_total).alias("_l"),
        F.sum(net_name).alias("_n"), F.sum(abs_name).alias("_a"),
        F.max(F.col(net_name) != 0).alias("_gap"),
    ]
    if period:
        per_key += [F.min(period).alias("_p0"), F.max(period).alias("_p1")]
    k = recon.groupBy(key).agg(*per_key)
    aggs = []
    if period:
        aggs += [F.min("_p0").alias("period_from"), F.max("_p1").alias("period_to")]
    aggs += [
        F.sum("_r").cast("bigint").alias(f"{right_total}_sum"),
        F.sum("_l").cast("bigint").alias(f"{left_total}_sum"),
        F.sum("_n").cast("bigint").alias(f"{net_name}_sum"),
        F.sum("_a").cast("bigint").alias(f"{abs_name}_sum"),
        F.count(F.col(key)).alias("accounts_total"),
        F.count_if(F.col(key).isNotNull() & F.col("_gap")).alias("accounts_with_gap"),
    ]
    return k.agg(*aggs)


def enrich_gaps(gaps: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]], how: str = "left",
                salt_by: Sequence[str] | None = None, rows_per_salt: int = 100_000) -> DataFrame:
    """Attach matching records to gap rows (D12, J10-J12). ``how='left'``
    keeps every gap row, ``how='right'`` every record: the same join with
    sides swapped. With ``salt_by`` (columns of the side that is attached, that
    vary within a key) the rows of each of its keys are spread over as many
    tasks as there are ``rows_per_salt`` of them, and rows without a key over
    all tasks (``joins.salted_left_join``)."""
    if salt_by:
        from .joins import salted_left_join
        if how == "left":
            return salted_left_join(gaps, other, on, salt_by, rows_per_salt)
        if how == "right":
            return salted_left_join(other, gaps, [(o, g) for g, o in on], salt_by, rows_per_salt)
    cond = None
    for gcol, ocol in on:
        c = gaps[gcol] == other[ocol]
        cond = c if cond is None else cond & c
    return gaps.join(other, cond, how)


def missing_keys(a: DataFrame, b: DataFrame, key: str, b_key: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (D16, U1): ``EXCEPT``
    semantics (distinct, nulls equal). Both sides are reduced to distinct
    keys first (partial aggregation folds a hot key map-side), then a
    null-safe anti join on the shared key partitioning."""
    left = a.select(F.col(key)).distinct()
    right = b.select(F.col(b_key or key).alias("__k")).distinct()
    return left.join(right, left[key].eqNullSafe(right["__k"]), "left_anti")


def incomplete_rows(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The rows lacking any of ``cols`` (P16, D17), with one flag per column."""
    flags = [F.col(c).isNull().alias(f"lacks_{c}") for c in cols]
    any_null = None
    for c in cols:
        x = F.col(c).isNull()
        any_null = x if any_null is None else any_null | x
    return df.where(any_null).select(*keep, *flags)


def completeness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and, per column, the rows where it is null."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in cols],
    )


def reconcile_changed(left: DataFrame, right: DataFrame, key: Sequence[str], left_total: str, right_total: str,
                      buckets: int = 65_536, **options) -> DataFrame:
    """The gap rows of ``reconcile`` by a checksum tree: keys are dealt into
    buckets; each side gives one order-free checksum and count per bucket (XOR
    of a hash of key and total), and only buckets that differ are joined row by
    row. Both sides hold one row per key. For two systems that mostly agree,
    equal buckets cost one pass of hashes and no shuffle of rows. Equal buckets
    could hide a gap only by a collision of 64-bit checksums and counts."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets))

    def sums(df: DataFrame, total: str, side: str) -> DataFrame:
        return df.groupBy(bucket.alias("_bucket")).agg(
            F.bit_xor(F.xxhash64(*key, F.col(total).cast("decimal(38,6)"))).alias(f"_{side}"), F.count(F.lit(1)).alias(f"_n{side}"))

    both = sums(left, left_total, "l").join(sums(right, right_total, "r"), "_bucket", "full")
    differ = both.where(~(F.col("_l").eqNullSafe(F.col("_r")) & F.col("_nl").eqNullSafe(F.col("_nr")))).select("_bucket")
    lacks = " OR ".join(f"`{k}` IS NULL" for k in key)  # such rows are gaps by themselves unless null keys match
    left, right = (df.withColumn("_bucket", bucket).where(f"NOT ({lacks})").join(differ, "_bucket", "left_semi").drop("_bucket")
                   .unionByName(df.where(lacks)) for df in (left, right))
    return reconcile(left, right, key, left_total, right_total, gaps_only=True, **options)

"""Root-cause labelling of gap rows.

The source asked the warehouse up to two queries per gap row. Here each rule
input is one key table, computed once over the whole source with a grouped
aggregate, then left-joined to the gap rows; the label is one ordered
``CASE`` over the joined flags. No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import period, previous_period

# The labels, in rule order.
LABEL_OWN_ACCOUNT = "own account"
LABEL_CHINA_MOVEOUT = "China moveout"
LABEL_NO_AGREEMENT = "Unable to connect reservation to a membership agreement"
LABEL_LATE_MOVEOUT = "HD move out one month late"
LABEL_SAME_TIME = "HD move in and move out at same time"
LABEL_OLD_HD = "Old HD missing move in and move out"
LABEL_REUSE = "Possible issue with reuse logic"


def label_gaps(gaps: DataFrame, rules: Sequence[tuple[Column, str]], default: str = "",
               name: str = "reason") -> DataFrame:
    """First rule that holds wins; a rule that is null counts as false."""
    if not rules:
        return gaps.withColumn(name, F.lit(default))
    expr = F.when(rules[0][0], F.lit(rules[0][1]))
    for cond, label in rules[1:]:
        expr = expr.when(cond, F.lit(label))
    return gaps.withColumn(name, expr.otherwise(F.lit(default)))


def late_moveouts(opps: DataFrame, key_cols: Sequence[str], measure: str, date_col: str,
                  order_cols: Sequence[str], unit: str = "month", target: int = -1) -> DataFrame:
    """Keys whose move-out was booked one period late.

    A negative opportunity closed in period p+1 is looked up by either of two
    keys; the first such row (earliest by ``order_cols``) must carry
    ``target``. Output: (key, period p). Exploding the two keys into rows
    turns the OR lookup into an equi join (R2); ``min_by`` is a partial
    aggregate, so a hot key is reduced on the map side.
    """
    p = previous_period(period(date_col, unit), unit)
    order = F.struct(*[F.col(c) for c in order_cols])
    rows = (opps.where(F.col(measure) < 0)
                .select(F.explode(F.array(*[F.col(k) for k in key_cols])).alias("key"),
                        p.alias("period"), order.alias("ord"), F.col(measure).alias("m"))
                .where(F.col("key").isNotNull()))
    return (rows.groupBy("key", "period").agg(F.min_by("m", "ord").alias("first_m"))
                .where(F.col("first_m") == target).select("key", "period"))


def same_day_pairs(ledger: DataFrame, key: str, date_col: str) -> DataFrame:
    """Keys with exactly two ledger rows, both on the same date."""
    return (ledger.where(F.col(key).isNotNull())
                  .groupBy(F.col(key).alias("key"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
                  .where((F.col("n") == 2) & (F.col("lo") == F.col("hi"))).select("key"))


def legacy_keys(opps: DataFrame, key: str, won_pred: Column, date_col: str, cutoff: str) -> DataFrame:
    """Keys whose first won opportunity closed before ``cutoff``."""
    return (opps.where(won_pred & F.col(key).isNotNull())
                .groupBy(F.col(key).alias("key"))
                .agg(F.min(date_col).alias("first_close"))
                .where(F.col("first_close") < F.lit(cutoff).cast("timestamp_ntz")))


def _spread(rows: DataFrame, key: str) -> Column:
    """The key, with each null replaced by a text that no key equals and that
    differs from row to row: nulls match nothing, but as they are they would
    all be shuffled to one task."""
    if rows.schema[key].dataType.simpleString() != "string":
        return rows[key]
    return F.coalesce(rows[key], F.concat(F.lit("\0"), F.xxhash64(*[rows[c] for c in rows.columns]).cast("string")))


def key_flag(rows: DataFrame, table: DataFrame, on: Sequence[tuple[str, str]], name: str,
             same_date: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Left-join a key table (unique on its keys) and set a boolean flag
    (J15). The key table is distinct by construction, so rows never
    multiply. ``same_date`` pairs are date columns compared as a residual
    test rather than as join keys, so the join is keyed by ``on`` alone and
    can reuse a partitioning of ``rows`` by those columns."""
    cols = list(on) + list(same_date)
    t = table.select(*[F.col(tc).alias(f"__{name}_{i}") for i, (_, tc) in enumerate(cols)]).distinct()
    t = t.withColumn(f"__{name}", F.lit(True))
    cond = None
    for i, (rc, _) in enumerate(cols):
        if i < len(on):
            c = _spread(rows, rc) == t[f"__{name}_{i}"]
        else:
            c = F.datediff(rows[rc], t[f"__{name}_{i}"]) == 0
        cond = c if cond is None else cond & c
    j = rows.join(t, cond, "left")
    return j.withColumn(name, F.coalesce(F.col(f"__{name}"), F.lit(False))).drop(
        f"__{name}", *[f"__{name}_{i}" for i in range(len(cols))])


def key_flags(rows: DataFrame, row_key: str, tables: dict[str, DataFrame], key: str = "key") -> DataFrame:
    """One boolean column per key table: does ``row_key`` appear in it.

    The key tables go through one union and one grouped pass (a key that
    fills a third of one table is folded map-side), giving one row per key
    with every flag; the rows then need a single left join on the key
    instead of one join per table.
    """
    names = list(tables)
    u = None
    for n in names:
        part = tables[n].select(F.col(key).alias("__k"), F.lit(n).alias("__t")).where(F.col("__k").isNotNull())
        u = part if u is None else u.unionByName(part)
    flags = u.groupBy("__k").agg(*[F.max(F.col("__t") == n).alias(f"__{n}") for n in names])
    j = rows.join(flags, _spread(rows, row_key) == flags["__k"], "left")
    return j.select(*[F.col(c) for c in rows.columns],
                    *[F.coalesce(F.col(f"__{n}"), F.lit(False)).alias(n) for n in names])

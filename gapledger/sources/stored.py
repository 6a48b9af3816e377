"""The ledger's tables stored once by order key, for the many plans that join
them on it.

Two tables bucketed alike meet without a shuffle, as do the lookups keyed by
the reservation that follow the ledger's own join. The store is a folder of
ordinary Parquet files and a one-row-per-table note of their layout; any
session can open it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

#: The ledger's tables and the column that holds the order key.
LEDGER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}
LAYOUT = "table string, key string, buckets int, columns string"


def store_tables(spark: SparkSession, base: str, folder: str, keys: dict[str, str] | None = None,
                 buckets: int | None = None, hottest: float = 4.0) -> None:
    """Write the tables named in ``keys`` under ``folder``, each bucketed and
    sorted by its key, one file per bucket.

    ``buckets`` defaults to the session's shuffle partitions. A bucket is read
    by one task and cannot be split, so where the fullest bucket of any table
    holds over ``hottest`` times the mean, as with one key that holds a third of
    the rows, all are stored without buckets: joins shuffle them as they do
    the source, and skewed partitions are split at run time. Rows are the same
    either way. A repeated call replaces the store.
    """
    keys = LEDGER_KEYS if keys is None else keys
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if any(fullest_bucket(read_table(spark, base, t), k, n) > hottest for t, k in keys.items()):
        n = 0
    for t, k in keys.items():
        rows = read_table(spark, base, t)
        if n:
            # The rows are dealt as the buckets are, so each is one file.
            writer = rows.repartition(n, k).write.bucketBy(n, k).sortBy(k)
            name = _name(folder, t)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            writer.mode("overwrite").option("path", f"{folder}/{t}.parquet").saveAsTable(name)
        else:
            rows.write.mode("overwrite").parquet(f"{folder}/{t}.parquet")
    note = [(t, k, n, _columns(read_table(spark, base, t))) for t, k in keys.items()]
    spark.createDataFrame(note, LAYOUT).coalesce(1).write.mode("overwrite").json(f"{folder}/layout")


def fullest_bucket(rows: DataFrame, key: str, buckets: int) -> float:
    """Rows of the fullest bucket as a multiple of the mean; 0 of an empty table."""
    each = rows.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    got = each.agg((F.max("n") * buckets / F.sum("n")).alias("x")).first()
    return float(got.x or 0)


def open_tables(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    """Table name -> reader, in any session, with the layout it was written in."""
    out = {}
    for r in spark.read.schema(LAYOUT).json(f"{folder}/layout").collect():
        path = f"{folder}/{r.table}.parquet"
        if r.buckets:
            name = _name(folder, r.table)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({r.columns}) USING parquet CLUSTERED BY (`{r.key}`) "
                      f"SORTED BY (`{r.key}`) INTO {r.buckets} BUCKETS LOCATION '{path}'")
            out[r.table] = partial(spark.table, name)
        else:
            out[r.table] = partial(spark.read.schema(r.columns).parquet, path)
    return out


def _columns(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def _name(folder: str, table: str) -> str:
    """A catalog name of this store's own."""
    return "`stored_" + "".join(c if c.isalnum() else "_" for c in folder) + f"_{table}`"

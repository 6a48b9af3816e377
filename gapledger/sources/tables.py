"""Table, log and CSV readers."""

from __future__ import annotations

import re
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


# (path, modification time) -> schema. Reading parquet without a schema runs a
# footer-reading job per call; a plan that reads the same table many times
# pays it once, and a table that is written again is looked at again.
_SCHEMAS: dict[tuple[str, int], StructType] = {}


# base -> its tables that are read from a store (``stored.store_tables``).
_STORED: dict[str, dict[str, Callable[[], DataFrame]]] = {}


@contextmanager
def reading_stored(base: str, tables: dict[str, Callable[[], DataFrame]]):
    """Plans built inside read these tables of ``base`` as given."""
    before = _STORED.get(base)
    _STORED[base] = tables
    try:
        yield
    finally:
        _STORED.pop(base)
        if before is not None:
            _STORED[base] = before


def _version(spark: SparkSession, path: str) -> tuple[str, int]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p)
    return path, status.getModificationTime()


def read_table(spark: SparkSession, base: str, name: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan of ``base/name.parquet``.

    Callers select the columns they need right after the scan, so Catalyst
    prunes the read schema and pushes their filters into the reader. The
    schema is inferred once per path (or given) and passed explicitly after.
    """
    if name in _STORED.get(base, {}):
        return _STORED[base][name]()
    path = f"{base.rstrip('/')}/{name}.parquet"
    if schema is None:
        version = _version(spark, path)
        schema = _SCHEMAS.get(version)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    _SCHEMAS[version] = df.schema
    return df


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Dots and runs of underscores become one underscore."""
    return df.toDF(*[re.sub(r"[._]+", "_", c) for c in df.columns])


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (S2). Splittable, so a big log is
    read by many tasks."""
    return spark.read.text(path)


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line count of a file written by an earlier job, as a one-row frame (S3)."""
    return read_log(spark, path).agg(F.count(F.lit(1)).alias("n_lines"))

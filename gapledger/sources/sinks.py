"""Writers (S4-S9).

Every writer is a distributed write: one part file per task, no pandas, no
collect. Paths should be on shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    """CSV with header, UTF-8 (S4). The row-number column of S5 is not data
    and is never written."""
    df.write.mode(mode).option("header", header).option("encoding", "UTF-8").csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append run results (S6). Each part file carries its own header, so a
    reader with ``header=True`` sees every part correctly."""
    write_csv(df, path, mode="append", header=True)


def write_run(df: DataFrame, path: str, run: str) -> None:
    """One run's rows of an appended CSV table (S6), as the partition
    ``run=...``: a repeated or retried run replaces its own rows, even by none,
    and leaves those of all other runs."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path.rstrip('/')}/run={run}")


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all runs that ``write_run`` wrote, with their ``run``."""
    return (spark.read.schema(StructType([*schema.fields, StructField("run", StringType())]))
            .option("header", True).option("escape", '"').csv(path))


def write_distinct_values(df: DataFrame, column: str, path: str) -> None:
    """One-column CSV of distinct, non-null values, no header."""
    (df.select(column).where(df[column].isNotNull()).distinct()
       .write.mode("overwrite").option("header", False).csv(path))


def write_report(df: DataFrame, path: str) -> None:
    """One-row totals report as JSON lines (S8, S9). The frame is already a
    single aggregated row, so one output file."""
    df.coalesce(1).write.mode("overwrite").json(path)

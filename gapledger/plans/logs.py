"""Log plans (D13-D15) over log lines derived from ``events``, and F6 over
``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text as _clean
from ..operators import logs
from ..sources import analogues as av
from ..sources.tables import read_table


# Analogue pairs (not reference values).
EXTRAS = {"ee": "e", "|": "", "the": "T"}


def exceptions(spark: SparkSession, base: str) -> DataFrame:
    return logs.exception_counts(av.exception_log_lines(spark, base))


def exception_texts(spark: SparkSession, base: str) -> DataFrame:
    """Every non-retry exception slice, one row per log line."""
    return logs.extract_exceptions(av.exception_log_lines(spark, base))


def failed_events(spark: SparkSession, base: str) -> DataFrame:
    return logs.extract_failed_events(av.failed_event_log_lines(spark, base))


def failed_event_keys(spark: SparkSession, base: str) -> DataFrame:
    return logs.failed_event_keys(failed_events(spark, base))


def error_rate(spark: SparkSession, base: str) -> DataFrame:
    """Failing contracts over all agreements (orders) created."""
    ag = read_table(spark, base, "orders")
    return logs.error_rate(failed_events(spark, base), ag, "o_orderdate", "o_orderkey")


def error_rate_text_ids(spark: SparkSession, base: str) -> DataFrame:
    """D15 where agreements bear text ids, some of them null."""
    ag = read_table(spark, base, "orders").select("o_orderdate", F.when(
        F.col("o_orderpriority") != "2-HIGH", F.concat(F.lit("C-"), F.col("o_orderkey").cast("string"))).alias("uuid"))
    return logs.error_rate(failed_events(spark, base), ag, "o_orderdate", "uuid")


def clean_text_extras(spark: SparkSession, base: str) -> DataFrame:
    """F6 with extra pairs: runs of one letter shrink, a letter goes, a word
    changes, and full stops are trimmed from the ends."""
    d = read_table(spark, base, "documents")
    return d.select("doc_id", _clean(F.col("text"), strip_chars=["."], replace_extras=EXTRAS).alias("clean_text"))


def clean_text(spark: SparkSession, base: str) -> DataFrame:
    """F6 over every document, whole text."""
    d = read_table(spark, base, "documents")
    return d.select("doc_id", _clean(F.col("text")).alias("clean_text"))

"""Log analytics (D13-D15): slice, filter, count, de-duplicate.

Lines are independent, so extraction is a narrow, codegen'd projection;
the only shuffles are the distinct counts (partial-aggregated, one row per
distinct value per task) and nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import open_range
from ..functions.text import clean_text, contains, slice_between, text_after, value_after

# The markers the log lines carry.
EXCEPTION_MARKER = "exception"
EXCEPTION_END = "id:"
RECORDS_MARKER = "records:"
RETRY_MARKER = "retry"
EVENT_KEY = "event_name"
COMPANY_KEY = "company_uuid"
CONTRACT_KEY = "membership_agreement_uuid"


def extract_exceptions(lines: DataFrame, col: str = "value") -> DataFrame:
    """Exception text of each line (D13): from the first ``exception`` to the
    next ``id:``, cut at ``records:``. Lines without the marker give nothing
    (B11); slices holding ``retry`` are dropped (the test looks at the
    slice, not the line)."""
    s = F.substring_index(slice_between(col, EXCEPTION_MARKER, EXCEPTION_END), RECORDS_MARKER, 1)
    out = lines.select(s.alias("exception"))
    return out.where(F.col("exception").isNotNull() & ~contains("exception", RETRY_MARKER))


def exception_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """Total non-retry exceptions and distinct ones, one row."""
    e = extract_exceptions(lines, col)
    return e.agg(F.count(F.lit(1)).alias("total_exceptions"),
                 F.count_distinct("exception").alias("unique_exceptions"))


def extract_failed_events(lines: DataFrame, col: str = "value") -> DataFrame:
    """Event, exception, company and contract of each failed-send line.

    Lines holding ``retry`` anywhere are dropped, and so are lines whose
    payload (first ``{`` to the next ``}``) names no event. Values are taken
    by pattern after their key (B12, B19): null when the key is absent. The
    contract is kept only when the payload names one.
    """
    v = F.col(col)
    pos = F.instr(v, "{")
    payload = F.when(pos > 0, F.substring_index(v.substr(pos + 1, F.length(v)), "}", 1))
    x = lines.where(~contains(col, RETRY_MARKER)).select(v.alias("_line"), payload.alias("_payload"))
    x = x.where(contains("_payload", EVENT_KEY))
    return x.select(
        clean_text(value_after("_payload", EVENT_KEY)).alias("event"),
        text_after("_line", EXCEPTION_MARKER).alias("exception"),
        clean_text(value_after("_line", COMPANY_KEY)).alias("company"),
        F.when(contains("_payload", CONTRACT_KEY),
               clean_text(value_after("_line", CONTRACT_KEY))).alias("contract"),
    )


def failed_event_keys(events: DataFrame) -> DataFrame:
    """Event rows, distinct companies and distinct contracts; one row.

    Both columns become (kind, value) pairs, grouped once with partial counts;
    two distinct counts in one aggregate would expand every row instead."""
    pairs = events.select(F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("company").alias("value")),
        F.struct(F.lit(1).alias("kind"), F.col("contract").alias("value")))).alias("p"))
    per_value = pairs.groupBy("p.kind", "p.value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    return per_value.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == 0, F.col("n"))), F.lit(0)).alias("n_events"),
        F.count_if((F.col("kind") == 0) & known).alias("n_companies"),
        F.count_if((F.col("kind") == 1) & known).alias("n_contracts"))


def error_rate(failures: DataFrame, agreements: DataFrame, created_col: str, id_col: str,
               start=None, end=None, contract_col: str = "contract") -> DataFrame:
    """Distinct failing contracts / agreements created in (start, end) x 100
    (D15, F18, P10; open range as in the source).

    Agreements are counted by the presence of an id, whatever its type. Both
    inputs go through one union and one global aggregate: no join of one-row
    frames, one pass over each side.
    """
    f = failures.select(F.col(contract_col).alias("_c"), F.lit(None).cast("int").alias("_a"))
    a = agreements.where(open_range(created_col, start, end)).select(
        F.lit(None).cast("string").alias("_c"), F.when(F.col(id_col).isNotNull(), F.lit(1)).alias("_a"))
    u = f.unionByName(a)
    agg = u.agg(F.count_distinct("_c").alias("failing_contracts"),
                F.count("_a").alias("agreements_created"))
    return agg.withColumn(
        "error_rate_pct",
        F.round(F.lit(100.0) * F.col("failing_contracts") / F.nullif(F.col("agreements_created"), F.lit(0)), 6))

"""The source's three entry points as Spark jobs that write their outputs.

1. aggregate reconciliation: gap rows + one-row summary (S4, S8, D1, D2, D11)
2. row-level reconciliation: labelled gap rows, gap rows with reuse records
   and lineage, summary (D1-D12)
3. log KPI: failed-send events appended, distinct companies and contracts,
   error rate against agreements (S2, S3, S6, S7, D14, D15)

Where one result feeds several outputs it is checkpointed once to the shared
folder named by ``spark.checkpoint.dir`` (``cut_lineage``): the upstream
joins run once, and a lost executor costs a re-read, not a recompute.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import open_range
from ..operators import logs
from ..operators import reconcile as rec
from ..session import checkpoint_dir, cut_lineage
from ..sources import analogues as av
from ..sources import sinks, stored, tables
from ..sources.tables import count_lines, read_log, read_table
from . import netsales, recon


def aggregate_reconciliation(spark: SparkSession, base: str, out: str) -> dict[str, str]:
    full = cut_lineage(recon.reconcile_accounts(spark, base, gaps_only=False))
    paths = {"output": os.path.join(out, "output"), "summary": os.path.join(out, "summary")}
    sinks.write_csv(full.where(F.col("net_gap") != 0), paths["output"])
    sinks.write_report(rec.summarize(full, "crm_total", "ledger_total", "account_id", "period"),
                       paths["summary"])
    return paths


def row_level_reconciliation(spark: SparkSession, base: str, out: str) -> dict[str, str]:
    all_rows = cut_lineage(recon.reconcile_contracts(spark, base, gaps_only=False))
    labelled = cut_lineage(recon.label_gaps(spark, base, all_rows.where(F.col("net_gap") != 0)))
    paths = {k: os.path.join(out, k) for k in ("output", "fulloutput", "summary")}
    sinks.write_csv(labelled, paths["output"])
    rr = av.reuse_records(spark, base).select("agreement_uuid", "company_id", "contract_event_type",
                                              "crm_response", "record_id")
    lineage = recon.agreement_lineage(spark, base).select(
        F.col("ma_uuid"), F.col("ma_created"), F.col("reservation_id"), F.col("reservable"))
    full = rec.enrich_gaps(labelled, rr, [("attributed_key", "agreement_uuid"), ("account_id", "company_id")],
                           salt_by=["record_id"])
    full = rec.enrich_gaps(full, lineage, [("attributed_key", "ma_uuid")], salt_by=["reservation_id"]).drop("ma_uuid")
    sinks.write_csv(full, paths["fulloutput"])
    sinks.write_report(rec.summarize(all_rows, "crm_total", "ledger_total", "account_id", "period"),
                       paths["summary"])
    return paths


def log_kpi(spark: SparkSession, log_path: str, agreements: DataFrame, created_col: str, id_col: str,
            out: str, start=None, end=None, run: str | None = None) -> DataFrame:
    """Extract failed sends from the log files at ``log_path`` (a folder of
    text files, read in parallel), append them as one run, write the distinct
    lists of all runs, then the KPI from the written contract list, as the
    source's second script did. ``run`` names the run (a digest of the path if
    not given); a run that is repeated replaces its own rows. Returns the
    one-row KPI frame (also written)."""
    new = logs.extract_failed_events(read_log(spark, log_path))
    paths = {k: os.path.join(out, k) for k in ("logfile", "unique_companies", "unique_contracts", "kpi")}
    sinks.write_run(new, paths["logfile"], run or hashlib.sha256(log_path.encode()).hexdigest()[:16])
    events = sinks.read_runs(spark, paths["logfile"], new.schema)
    sinks.write_distinct_values(events, "company", paths["unique_companies"])
    sinks.write_distinct_values(events, "contract", paths["unique_contracts"])
    failing = count_lines(spark, paths["unique_contracts"])
    created = agreements.where(open_range(created_col, start, end)).agg(
        F.count(id_col).alias("agreements_created"))
    kpi = _one_row_merge(failing, created)
    kpi = kpi.select(F.col("n_lines").alias("failing_contracts"), "agreements_created",
                     F.round(F.lit(100.0) * F.col("n_lines") / F.nullif(F.col("agreements_created"), F.lit(0)), 6)
                     .alias("error_rate_pct"))
    sinks.write_report(kpi, paths["kpi"])
    return kpi


def _one_row_merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Put two one-row aggregates side by side without a join: both become
    rows of one union, merged by a global aggregate."""
    cols_a, cols_b = a.columns, b.columns
    ua = a.select(*[F.col(c) for c in cols_a], *[F.lit(None).cast("long").alias(c) for c in cols_b])
    ub = b.select(*[F.lit(None).cast("long").alias(c) for c in cols_a], *[F.col(c) for c in cols_b])
    return ua.unionByName(ub).agg(*[F.max(c).alias(c) for c in cols_a + cols_b])


def log_kpi_of_events(spark: SparkSession, base: str) -> DataFrame:
    """The log KPI job on log files made of ``events``: text scan, appended
    and distinct CSV lists, line count and KPI (S2, S3, S6, S7, S8). Its
    folder lies in the shared checkpoint folder."""
    out = os.path.join(checkpoint_dir(spark), f"log-kpi-{uuid.uuid4().hex}")
    log = write_log_lines(spark, base, out)
    return log_kpi(spark, log, read_table(spark, base, "orders"), "o_orderdate", "o_orderkey", out)


def log_runs(spark: SparkSession, base: str) -> DataFrame:
    """Two runs of the log job, the first of them repeated, on two
    folders of log lines of ``events``; the appended rows as read back."""
    out = os.path.join(checkpoint_dir(spark), f"log-runs-{uuid.uuid4().hex}")
    lines = av.failed_event_log_lines(spark, base)
    agreements = read_table(spark, base, "orders")
    for run in ("0", "1", "0"):
        log = os.path.join(out, "log", run)
        lines.where(F.length("value") % 2 == int(run)).write.mode("overwrite").text(log)
        log_kpi(spark, log, agreements, "o_orderdate", "o_orderkey", out, run=f"r{run}")
    schema = logs.extract_failed_events(lines).schema
    return sinks.read_runs(spark, os.path.join(out, "logfile"), schema).select("run", *schema.names)


def _on_stored_ledger(spark: SparkSession, base: str, plan) -> DataFrame:
    """``plan`` over the ledger's tables as stored by order key."""
    folder = os.path.join(checkpoint_dir(spark), f"ledger-{uuid.uuid4().hex}")
    stored.store_tables(spark, base, folder)
    with tables.reading_stored(base, stored.open_tables(spark, folder)):
        return plan(spark, base)


def resolve_contracts_stored(spark: SparkSession, base: str) -> DataFrame:
    """D9 over the stored ledger: no shuffle below its joins."""
    return _on_stored_ledger(spark, base, recon.resolve_contracts)


def label_gaps_stored(spark: SparkSession, base: str) -> DataFrame:
    """D5 over the stored ledger."""
    return _on_stored_ledger(spark, base, recon.label_gaps)


def net_sales_levels_stored(spark: SparkSession, base: str) -> DataFrame:
    """D4 at all levels over the stored ledger: the first shuffle is that of
    the sums per location (J6)."""
    return _on_stored_ledger(spark, base, netsales.net_sales_levels)


def summary_through_json(spark: SparkSession, base: str) -> DataFrame:
    """The totals of the account reconciliation, as the job writes them,
    read from its report file."""
    totals = recon.reconcile_summary(spark, base)
    path = os.path.join(checkpoint_dir(spark), f"summary-{uuid.uuid4().hex}")
    sinks.write_report(totals, path)
    return spark.read.schema(totals.schema).json(path)


def gaps_through_csv(spark: SparkSession, base: str) -> DataFrame:
    """The account gap rows as the job writes them, read from its CSV file
    (S4, S5)."""
    gaps = recon.reconcile_accounts(spark, base)
    path = os.path.join(checkpoint_dir(spark), f"gaps-{uuid.uuid4().hex}")
    sinks.write_csv(gaps, path)
    return spark.read.schema(gaps.schema).option("header", True).csv(path)


def write_log_lines(spark: SparkSession, base: str, out: str) -> str:
    """Materialise the analogue failed-send log lines as text files, the
    input shape of ``log_kpi`` (used by tests and demos)."""
    path = os.path.join(out, "log")
    av.failed_event_log_lines(spark, base).write.mode("overwrite").text(path)
    return path


def run_all(spark: SparkSession, base: str, out: str) -> dict[str, dict[str, str] | str]:
    res: dict[str, dict[str, str] | str] = {
        "aggregate": aggregate_reconciliation(spark, base, os.path.join(out, "aggregate")),
        "row_level": row_level_reconciliation(spark, base, os.path.join(out, "row_level")),
    }
    log = write_log_lines(spark, base, out)
    log_kpi(spark, log, read_table(spark, base, "orders"), "o_orderdate", "o_orderkey", os.path.join(out, "kpi"))
    res["kpi"] = os.path.join(out, "kpi")
    return res

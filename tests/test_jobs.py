"""End-to-end jobs and the streaming extractor, on sf0.001."""

import os
import tempfile

from pyspark.sql import functions as F

from gapledger.operators import logs
from gapledger.plans import jobs, recon
from gapledger.sources import analogues as av
from gapledger.streaming import log_events


def test_jobs_write_consistent_outputs(spark, base):
    out = tempfile.mkdtemp(prefix="gapledger-jobs-")
    res = jobs.run_all(spark, base, out)
    gaps = spark.read.option("header", True).csv(res["aggregate"]["output"])
    assert gaps.count() == recon.reconcile_accounts(spark, base).count()
    summ = spark.read.json(res["aggregate"]["summary"]).first()
    assert summ.net_gap_sum == summ.crm_total_sum - summ.ledger_total_sum
    lab = spark.read.option("header", True).csv(res["row_level"]["output"])
    assert lab.count() == recon.label_gaps(spark, base).count()
    full = spark.read.option("header", True).csv(res["row_level"]["fulloutput"])
    assert full.count() >= lab.count()
    kpi = spark.read.json(os.path.join(res["kpi"], "kpi")).first()
    want = logs.failed_event_keys(logs.extract_failed_events(av.failed_event_log_lines(spark, base))).first()
    assert kpi.failing_contracts == want.n_contracts
    assert kpi.agreements_created == spark.read.parquet(f"{base}/orders.parquet").count()


def test_streaming_matches_batch(spark, base):
    d = tempfile.mkdtemp(prefix="gapledger-stream-")
    log_dir = os.path.join(d, "logs")
    lines = av.failed_event_log_lines(spark, base)
    # two files arriving one after the other
    lines.where(F.length("value") % 2 == 0).write.text(os.path.join(log_dir, "a"))
    lines.where(F.length("value") % 2 == 1).write.text(os.path.join(log_dir, "b"))
    q = log_events.failed_events_to_csv(spark, os.path.join(log_dir, "*"), os.path.join(d, "events"),
                                        checkpoint=os.path.join(d, "ckpt1"))
    q.awaitTermination()
    got = spark.read.option("header", True).csv(os.path.join(d, "events"))
    want = logs.extract_failed_events(lines)
    assert got.count() == want.count()
    assert got.select("contract").distinct().count() == want.select("contract").distinct().count()

    exc_dir = os.path.join(d, "exc_logs")
    av.exception_log_lines(spark, base).write.text(exc_dir)
    q2 = log_events.exception_counts_to_path(spark, exc_dir, os.path.join(d, "exc"),
                                             checkpoint=os.path.join(d, "ckpt2"))
    q2.awaitTermination()
    cur = log_events.latest_exception_counts(spark, os.path.join(d, "exc"))
    batch = logs.exception_counts(av.exception_log_lines(spark, base)).first()
    agg = cur.agg(F.sum("count").alias("t"), F.count("*").alias("u")).first()
    assert (agg.t, agg.u) == (batch.total_exceptions, batch.unique_exceptions)

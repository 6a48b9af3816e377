"""Session factory and lineage helpers.

Cluster runs get their settings from spark-submit; this module only fills in
what is missing, so the same code runs on a laptop and on a cluster.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Timestamps in the inputs are zone-less
# (timestamp_ntz); pinning the session zone keeps any LTZ cast stable.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when the operator above relied on
    # the join's partitioning (e.g. an aggregate on the same key): a hot key
    # then costs one extra, map-side-combined shuffle instead of one task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def shuffle_sizing(input_bytes: int, total_cores: int, scan_bytes: int = 256 << 20,
                   input_per_partition: int = 512 << 20) -> dict[str, str]:
    """Shuffle settings for a run over ``input_bytes`` of parquet on
    ``total_cores`` executor cores.

    One shuffle partition per ``input_per_partition`` of input: the shuffles
    here carry pruned columns and partial aggregates, a fraction of the input
    bytes, so a partition stays a few hundred MB and spills gracefully. At
    least two waves of cores. AQE coalesces small stages towards the advisory
    size and splits skewed partitions.
    """
    parts = max(2 * total_cores, -(-input_bytes // input_per_partition))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def get_session(
    app: str = "gapledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    input_bytes: int | None = None,
    total_cores: int | None = None,
) -> SparkSession:
    """Return the active session, or build one with the defaults above.

    ``master`` and ``shuffle_partitions`` are only applied when given; on a
    cluster pass ``input_bytes`` and ``total_cores`` (or size partitions with
    spark-submit).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if input_bytes and total_cores:
        conf.update(shuffle_sizing(input_bytes, total_cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; without it a cluster job
    fails, because its executors share no other folder. Only a one-process
    ``local`` master (tests, laptops) gets a local folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="gapledger-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    # SparkContext.getCheckpointDir returns a per-application sub folder once set.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    A reliable checkpoint survives executor loss; it is used where one result
    feeds several outputs, so the upstream joins run once.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

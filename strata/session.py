"""Spark session settings shared by jobs, tests and the benchmark.

Jobs never build their own session on a cluster: they take the one
``spark-submit`` gives them and only fill in settings that are unset.
"""

from __future__ import annotations

import math
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Time zone: `datediff` works on calendar
# dates in the session zone, so the lifecycle day counts are only stable
# when it is pinned.
JOB_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tag maps coming from list-of-pairs input keep the last duplicate key.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "strata", extra: dict | None = None) -> SparkSession:
    """A local-mode session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**JOB_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_job_settings(spark)
    return spark


def ensure_job_settings(spark: SparkSession) -> SparkSession:
    """Apply JOB_DEFAULTS where the session leaves them unset.

    The time zone is always pinned: a cluster default other than UTC would
    silently change every day count.
    """
    conf = spark.conf
    for k, v in JOB_DEFAULTS.items():
        if k == "spark.sql.session.timeZone":
            conf.set(k, v)
        elif conf.get(k, None) is None:
            conf.set(k, v)
    return spark


# Input bytes for which a shuffle gets one partition before AQE coalesces small
# ones, and shuffle bytes to which it coalesces them. Both are compressed: in the
# hash maps and sort buffers of the lifecycle they take 30 to 45 times as much.
SHUFFLE_TARGET_BYTES = 4 << 20
ADVISORY_BYTES = 16 << 20
# Marks what ``resize_partitions`` has set, beside what the deployment has set.
SIZED = "strata.sized."


def plan_bytes(*frames: DataFrame) -> int:
    """What Spark's statistics say the frames' inputs hold (file sizes; a
    metadata call on the driver, nothing is read)."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        total += sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return total


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as Spark's settings write it ("64m", "67108864b"); a plain number is bytes."""
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def size_partitions(spark: SparkSession, n_bytes: int) -> dict[str, str]:
    """Fill partition sizing from the input size where the deployment left it
    unset; returns what was set. A larger advisory size than ``ADVISORY_BYTES`` is
    lowered to it, Spark's own default of 64 MB included: it bounds a task's memory.

    AQE starts every shuffle at ``initialPartitionNum`` (one partition for
    ``SHUFFLE_TARGET_BYTES`` of the whole input) and coalesces the small ones to
    the advisory size. The memory of a task then depends on these two, not on the
    size of the input, which 200 partitions of a cluster's default would follow.
    """
    conf = spark.conf
    out = {}
    advisory = conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    if advisory is None or _bytes(spark, advisory) > ADVISORY_BYTES:
        out["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(ADVISORY_BYTES)
    if conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None:
        current = int(conf.get("spark.sql.shuffle.partitions"))
        want = max(current, math.ceil(n_bytes / SHUFFLE_TARGET_BYTES))
        if n_bytes >= 1 << 60:
            want = current        # no statistics: Spark's default size for the unknown
        if want > current:
            out["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(want)
    for k, v in out.items():
        conf.set(k, v)
    return out


def resize_partitions(spark: SparkSession, n_bytes: int) -> dict[str, str]:
    """``size_partitions`` where the session may have sized a smaller or larger
    input before: what an earlier call has set is set anew, what the deployment has
    set stays (but for an advisory size that is too large)."""
    conf = spark.conf
    for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"):
        if conf.get(SIZED + k, None) is not None and conf.get(SIZED + k) == conf.get(k, None):
            conf.unset(k)
        conf.unset(SIZED + k)
    out = size_partitions(spark, n_bytes)
    for k, v in out.items():
        conf.set(SIZED + k, v)
    return out


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem
    every executor reaches). Only a local-mode session without it gets a
    fresh scratch folder, as in tests.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; jobs that cut lineage "
                               "need a shared checkpoint folder on the cluster")
        d = tempfile.mkdtemp(prefix="strata-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d

"""Session settings and shared storage locations."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are UTC instants; AQE re-plans joins and
# coalesces small shuffle partitions at run time; hot join keys are split by AQE.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
    # Static size estimates come from file sizes; compressed columnar and JSON
    # files expand in memory, so estimates are scaled up before the planner
    # compares them with the broadcast threshold (runtime AQE decisions use
    # measured shuffle sizes instead).
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is left to spark-submit when ``None``. On a cluster pass
    ``extra=sized_conf(shuffle_bytes, cores)`` so a shuffle partition holds about
    128 MB; AQE coalesces what turns out smaller.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # Session-level settings also apply when the session already existed.
    for key in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
                "spark.sql.sources.partitionColumnTypeInference.enabled"):
        spark.conf.set(key, conf[key])
    return spark


def sized_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Settings sized so a shuffle partition stays near ``target_partition_bytes``
    (fits in executor memory without much spilling).

    ``shuffle_bytes`` is the expected size of the largest shuffle — after column
    pruning and partial aggregation, usually far below the raw input. At least 2
    partitions per core; AQE coalesces what turns out smaller and splits skewed
    partitions above 4× the target. E.g. a 10 TiB shuffle on 1000 executors × 8
    cores → 81,920 partitions."""
    partitions = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir", None)
        master = spark.sparkContext.master
        if not root or (root.startswith(("file:", "/")) and not (master == "local" or master.startswith("local["))):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared root for one job's outputs,
    grouped by UTC day so old scratch can be expired per day folder."""
    import datetime as _dt

    day = _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")
    return f"{shared_root(spark)}/tidemark/{day}/{name}-{uuid.uuid4().hex[:12]}"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package from where it lies.

    On a cluster the package is installed or shipped with the job, and this changes nothing.
    """
    here = str(Path(__file__).resolve().parents[1])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(":") if p]
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([here, *paths])


def ensure_session_tz(spark: SparkSession) -> None:
    """Run stamps and timestamps are UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")

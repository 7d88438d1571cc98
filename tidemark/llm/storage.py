"""Where intermediate tables go, and how the given tables are read."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import importable  # noqa: F401


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset (tests).

    Raises on a cluster where neither names a shared folder: files on one machine are not seen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if root.startswith(("file:", "/")) and not local:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def day_folder(spark: SparkSession) -> str:
    """This subpackage's folder of the UTC day under the shared folder, to be expired by day."""
    day = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")
    return f"{shared_root(spark)}/tidemark-llm/{day}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back.

    Cuts the lineage: a lost executor repeats tasks of the current step only. Values
    that Spark made per row (sequence numbers, for instance) are fixed from here on.
    """
    spark = df.sparkSession
    path = f"{day_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with one more column ``name``: a number that differs between rows.

    It is not stable between two evaluations; write the result before relying on it.
    """
    return df.withColumn(name, F.monotonically_increasing_id())

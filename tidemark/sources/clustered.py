"""Stored runs clustered by id, so that two of them join without a shuffle.

A run is written as files of hash buckets of its key, each sorted by it, in a folder of its own
beside a small description (key, number of buckets, schema). Reading declares the folder to Spark
as a bucketed table, only while the plan is made, so nothing is left in the session's catalog.
Two runs with the same number of buckets are joined on the key bucket by bucket.

    <root>/run=20240101T000000Z/part-*.parquet, <root>/run=20240101T000000Z.json
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import child_folders, read_whole, remove_folder, write_whole

RUN = "run"


def write_clustered(df: DataFrame, root: str, run: str, key: str, buckets: int) -> None:
    """Write one run, or replace it. ``buckets`` should put some 128 MB to 1 GB in one, and be the same for all runs of a root.

    One exchange, by the key, so a bucket is one file. Rows of one key lie in one bucket, as for any hash join.
    """
    spark, folder = df.sparkSession, f"{root}/{RUN}={run}"
    remove_folder(spark, f"{folder}.json")  # a run without its description isn't there
    name = f"clustered_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode("overwrite").option("path", folder).bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"drop table {name}")  # its files stay
    write_whole(spark, f"{folder}.json", json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()}))


def read_clustered(spark: SparkSession, root: str, run: str) -> DataFrame:
    """One run. Its plan carries the clustering; a join or grouping on the key needs no exchange of it."""
    folder = f"{root}/{RUN}={run}"
    text = read_whole(spark, f"{folder}.json")
    if text is None:
        raise FileNotFoundError(f"{folder}: no clustered run was written here")
    told = json.loads(text)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(told["schema"]).fields)
    name = f"clustered_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{told['key']}`) sorted by (`{told['key']}`) "
              f"into {told['buckets']} buckets location '{folder}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"drop table {name}")  # the plan has all it needs; the files stay


def clustered_runs(spark: SparkSession, root: str) -> list[str]:
    """The runs that were written whole, oldest first."""
    return sorted(run for run in child_folders(spark, root, RUN) if read_whole(spark, f"{root}/{RUN}={run}.json") is not None)

"""Processed tables: the "latest" table and the run-partitioned snapshot table.

Snapshots are partitioned by ``ingestion_date`` (yyyy-MM-dd) and ``snapshot_ts``
(the compact run stamp), so one run is one partition; writing a run again replaces
exactly that partition (dynamic overwrite).
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas as S
from tidemark.functions.coerce import format_stamp, parse_stamp, stamp_date
from tidemark.sources.files import child_folders, read_whole, write_whole

PINS = "_pins"  # hidden from readers of the snapshot table


def write_latest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def with_snapshot_partitions(df: DataFrame, stamp: str = S.STAMP) -> DataFrame:
    """Add ``ingestion_date`` and ``snapshot_ts`` derived from each row's run stamp.

    A stamp that does not parse fails the job (``raise_error``), checked per row
    inside the write, without a separate pass.
    """
    ts = parse_stamp(stamp)
    checked = F.when(ts.isNull(), F.raise_error(F.concat(F.lit("unparseable run stamp: "),
                                                          F.coalesce(F.col(stamp), F.lit("NULL")))))
    checked = checked.otherwise(ts)
    return df.withColumns({"ingestion_date": stamp_date(checked), "snapshot_ts": format_stamp(checked)})


def write_snapshots(df: DataFrame, root: str, stamp: str = S.STAMP, many_runs: bool = False) -> None:
    """Write the rows of one or more runs into the snapshot table at ``root``.

    One run: tasks write straight to its partition (no shuffle). ``many_runs``
    (backfill): a ``rebalance`` hint on the partition columns lets AQE give each
    run files of the advisory size — a run holding a third of the rows is split,
    small runs are merged — instead of every task writing a small file per run.
    """
    out = with_snapshot_partitions(df, stamp)
    if many_runs:
        out = out.hint("rebalance", *S.SNAPSHOT_PARTITIONS)
    (out
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*S.SNAPSHOT_PARTITIONS)
     .parquet(root))


def read_snapshots(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The whole snapshot table with a fixed schema (partition values as text)."""
    return spark.read.schema(S.snapshot_schema(schema)).parquet(root)


def run_path(root: str, stamp: str) -> str:
    """Partition folder of one run (stamps are ``yyyyMMdd'T'HHmmss'Z'``)."""
    return f"{root}/ingestion_date={stamp[0:4]}-{stamp[4:6]}-{stamp[6:8]}/snapshot_ts={stamp}"


def read_runs(spark: SparkSession, root: str, schema: T.StructType, stamps: list[str]) -> DataFrame:
    """Only the given runs, read by their partition folders: the driver lists
    those folders instead of the whole table (which may hold years of runs)."""
    return (spark.read.schema(S.snapshot_schema(schema)).option("basePath", root)
            .parquet(*[run_path(root, s) for s in stamps]))


def read_processed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """A processed table written by another tool (a latest file, or a folder of
    per-run files such as ``ingestion_date=YYYY-MM-DD/<feed>_<stamp>.parquet``),
    conformed to the feed's schema. Files from pandas store timestamps as
    nanoseconds, which Spark reads only as integers — the reader is told so."""
    from tidemark.operators.normalize import conform

    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")  # the schema is read, and the setting taken into the plan, here
    try:
        return conform(spark.read.parquet(path), feed)
    finally:
        spark.conf.set(setting, before)


def newest_runs(spark: SparkSession, root: str, n: int = 2) -> list[str]:
    """Stamps of the ``n`` newest runs of the snapshot table at ``root``, oldest first.

    Lists the day folders and the newest days' run folders. Raises ValueError where there are fewer runs.
    """
    found: list[str] = []
    for day in child_folders(spark, root, "ingestion_date"):
        found += child_folders(spark, f"{root}/ingestion_date={day}", "snapshot_ts")
        if len(found) >= n:
            break
    if len(found) < n:
        raise ValueError(f"{root} holds {len(found)} run(s) and {n} are needed; run the job again after the next landing")
    return found[:n][::-1]


def pin_runs(spark: SparkSession, root: str, n: int = 2) -> str:
    """Choose the ``n`` newest runs for all readers of one job: a small file notes them, and its name (returned) is the
    version that ``pinned_runs`` reads. Runs that land later don't change it."""
    runs = newest_runs(spark, root, n)
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    write_whole(spark, f"{root}/{PINS}/{version}.json", json.dumps(runs))
    return version


def pinned_runs(spark: SparkSession, root: str, version: str) -> list[str]:
    """The stamps of a version, oldest first."""
    text = read_whole(spark, f"{root}/{PINS}/{version}.json")
    if text is None:
        raise FileNotFoundError(f"{root}: no version {version} of chosen runs")
    return json.loads(text)


def pick_snapshot(snapshots: DataFrame, stamp: str) -> DataFrame:
    """One run, by literal partition filter (static partition pruning)."""
    return snapshots.where(F.col("snapshot_ts") == F.lit(stamp))


def newest_two_in_plan(df: DataFrame, stamp: str = S.STAMP) -> tuple[DataFrame, DataFrame]:
    """(latest, previous) runs of ``df`` chosen inside the plan by scalar subqueries over the
    distinct stamps, without a driver round trip. Running the plan fails where there are
    fewer than two runs."""
    stamps = df.select(F.col(stamp).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    newest = F.sort_array(F.collect_set("_s"), asc=False)
    few = F.raise_error(F.concat(F.lit("two runs are needed to compare, found "), F.size(newest).cast("string")))

    def nth(n: int) -> Column:
        return stamps.agg(F.when(F.size(newest) < 2, few).otherwise(F.get(newest, n)).alias("_s")).scalar()
    return df.where(F.col(stamp) == nth(0)), df.where(F.col(stamp) == nth(1))

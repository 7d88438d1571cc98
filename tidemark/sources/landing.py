"""Raw landing zone.

Records are landed one JSON object per line. Each landing writes a folder of its own and is
published by one small file that names it, so a run is seen whole or not at all:

    <root>/attempt=20240101T000500123456-1f2e3d4c/ingested_at_utc=20240101T000000Z/part-*.json
    <root>/manifest/01704067500123456789-20240101T000500123456-1f2e3d4c.json

A run's records are those of the folder published last for its stamp: landing a stamp again
replaces that run only, and a landing that fails before its file is there changes nothing. A
manifest line holds a run's source, endpoint, stamp, record count (counted by the tasks that wrote
it) and folder. Every record carries ``source`` and ``endpoint``; the stamp lives in the path.

Single-document envelopes (``{source, endpoint, ingested_at_utc, record_count, data: [...]}``) of
other tools are read by ``documents.read_documents``, in many tasks; ``read_envelopes`` reads small
ones, a task each.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.sources.files import child_folders, remove_folder, write_whole

MANIFEST = "manifest"
ATTEMPT = "attempt"
MANIFEST_SCHEMA = f"source string, endpoint string, record_count long, {S.STAMP} string, {ATTEMPT} string, published long"
#: Runs that one landing may hold; their counts are exact up to it.
MOST_RUNS = 100_000


def land_records(
    records: DataFrame,
    root: str,
    source: str,
    endpoint: str,
    stamp: str | Column,
) -> None:
    """Land one run, or, with a Column as ``stamp``, several at once. Runs of the same stamp are replaced, others untouched.

    ``records`` holds one row per raw record; nested values may be STRUCT, ARRAY or VARIANT columns and are written as
    JSON. Records are counted run by run while they are written. A single run without records is a run with count 0; of
    several at once such a run can't be told. Rows without a stamp fail the landing.
    """
    spark = records.sparkSession
    attempt = f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/{ATTEMPT}={attempt}"
    own = records.withColumns({"source": F.lit(source), "endpoint": F.lit(endpoint)})
    seen, count = Observation(), F.count(F.lit(1)).alias("records")
    if isinstance(stamp, str):
        own.observe(seen, count).write.json(f"{folder}/{S.STAMP}={stamp}")
        counts = {stamp: seen.get["records"]}
    else:
        # Few enough values are counted exactly; the sum below tells if they were too many.
        by_run = F.expr(f"approx_top_k({S.STAMP}, {MOST_RUNS}, {10 * MOST_RUNS})").alias("runs")
        own.withColumn(S.STAMP, stamp).observe(seen, count, by_run).write.partitionBy(S.STAMP).json(folder)
        counts = {r[0]: r[1] for r in seen.get["runs"]}
        if None in counts or sum(counts.values()) != seen.get["records"]:
            raise ValueError(f"{root}: every record needs a run stamp, and a landing may hold {MOST_RUNS} runs")
    _publish(spark, root, attempt, source, endpoint, counts)


def _publish(spark: SparkSession, root: str, attempt: str, source: str, endpoint: str, counts: dict[str, int]) -> None:
    """One file, there at once or not at all, makes the attempt's runs the current ones."""
    published = time.time_ns()
    lines = [json.dumps({"source": source, "endpoint": endpoint, "record_count": n, S.STAMP: run, ATTEMPT: attempt, "published": published})
             for run, n in sorted(counts.items())]
    if lines:
        write_whole(spark, f"{root}/{MANIFEST}/{published:020d}-{attempt}.json", "\n".join(lines) + "\n")


def _published(spark: SparkSession, root: str) -> DataFrame:
    """The current manifest: one row per run, that of the folder published last."""
    try:
        rows = spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(f"{root}/{MANIFEST}")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc):
            raise FileNotFoundError(f"{root}: no run was landed here; land one with land_records") from exc
        raise
    newest = F.max_by(F.struct("source", "endpoint", "record_count", ATTEMPT), F.struct("published", ATTEMPT)).alias("r")
    return rows.groupBy(S.STAMP).agg(newest).select("r.source", "r.endpoint", "r.record_count", S.STAMP, f"r.{ATTEMPT}")


def landed_runs(spark: SparkSession, root: str) -> DataFrame:
    """The run manifest: (source, endpoint, record_count, stamp), one row per run. Reads one small file
    per landing and no raw byte."""
    return _published(spark, root).drop(ATTEMPT)


def current_runs(spark: SparkSession, root: str) -> list[tuple[str, int, str]]:
    """``(stamp, record count, landing)`` of every run, oldest first: what a reader sees now."""
    return [(r[S.STAMP], r["record_count"], r[ATTEMPT]) for r in _published(spark, root).orderBy(S.STAMP).collect()]


def run_folders(spark: SparkSession, root: str, stamps: list[str] | None = None) -> list[str]:
    """The current folders of the runs, by stamp: one path for each run reaches the driver."""
    runs = _published(spark, root)
    runs = runs if stamps is None else runs.where(F.col(S.STAMP).isin(stamps))
    folders = [f"{root}/{ATTEMPT}={r[ATTEMPT]}/{S.STAMP}={r[S.STAMP]}" for r in runs.orderBy(S.STAMP).collect()]
    if len(folders) < len(stamps or folders[:1]) or not folders:
        raise FileNotFoundError(f"{root}: no such run was landed here ({', '.join(stamps or ['any'])})")
    return folders


def read_landed(spark: SparkSession, root: str, feed: str, stamps: list[str] | None = None) -> DataFrame:
    """Landed records of ``feed`` (``markets``, ``protocols``, ``stablecoins``), of all runs or those of ``stamps``: every
    field as text (nested ones as VARIANT), plus envelope columns. Only the runs' current folders are listed."""
    schema = S.landed_schema(S.FEEDS[feed]["raw"])
    return (spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", root)
            .json(run_folders(spark, root, stamps)).drop(ATTEMPT))


def newest_landed_run(spark: SparkSession, root: str) -> tuple[str, int]:
    """Stamp and record count of the newest run, which may hold no record."""
    row = landed_runs(spark, root).orderBy(F.desc(S.STAMP)).select(S.STAMP, "record_count").first()
    if row is None:
        raise FileNotFoundError(f"{root}: the run manifest is empty; land a run with land_records")
    return row[0], row[1]


def read_landed_run(spark: SparkSession, root: str, feed: str, stamp: str) -> DataFrame:
    """One landed run, read by its folder (only that folder is listed)."""
    return read_landed(spark, root, feed, [stamp])


def read_newest_landed(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """Records of the newest landed run: none where that run is empty."""
    stamp, _ = newest_landed_run(spark, root)
    return read_landed_run(spark, root, feed, stamp)


def remove_superseded(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Remove the folders of runs that were landed again, and of landings that never were published; returns how many.

    Younger ones stay: a landing may still be running, a reader may still hold an older manifest.
    """
    current = {(r[ATTEMPT], r[S.STAMP]) for r in _published(spark, root).select(ATTEMPT, S.STAMP).collect()}
    before, removed = f"{dt.datetime.now(dt.timezone.utc) - older_than:%Y%m%dT%H%M%S%f}", 0
    for attempt in child_folders(spark, root, ATTEMPT):
        if attempt >= before:
            continue
        for stamp in child_folders(spark, f"{root}/{ATTEMPT}={attempt}", S.STAMP):
            if (attempt, stamp) not in current:
                remove_folder(spark, f"{root}/{ATTEMPT}={attempt}/{S.STAMP}={stamp}")
                removed += 1
    return removed


def newest_stamp(df: DataFrame, stamp: str = S.STAMP) -> Column:
    """The newest run stamp of ``df`` as a scalar subquery (stamps sort as time)."""
    return df.select(F.max(stamp)).scalar()


def newest_run(df: DataFrame, stamp: str = S.STAMP) -> DataFrame:
    """Rows of the newest run only. On a stamp-partitioned source the filter is a
    partition filter evaluated once, before the scan."""
    return df.where(F.col(stamp) == newest_stamp(df, stamp))


PAGE_RECORDS = 250  # records of one page at most: a fixed value of the source's paging


def land_pages(records: DataFrame, root: str, feed: str, source: str, endpoint: str, page: Column, stamp: Column) -> None:
    """Land records in pages: one JSON line for each page of a run, its records in a list.

    ``page`` numbers a record's page within its run and must put at most ``PAGE_RECORDS`` on one,
    so a group is bounded; a larger page fails. Feeds that nest their list do so here, too.
    """
    nested = S.FEEDS[feed]["nested_key"]
    own = records.select(stamp.alias(S.STAMP), page.alias("page"),
                         F.struct(*[F.col(c) for c in records.columns if c != S.STAMP]).alias("record"))
    pages = own.groupBy(S.STAMP, "page").agg(F.collect_list("record").alias("data"))
    size = F.size("data")
    data = F.when(size > PAGE_RECORDS, F.raise_error(F.concat(F.lit("a page holds "), size.cast("string"), F.lit(" records")))) \
        .otherwise(F.col("data"))
    data = F.struct(data.alias(nested)) if nested else data
    (pages.select(F.lit(source).alias("source"), F.lit(endpoint).alias("endpoint"), S.STAMP,
                  size.cast("long").alias("record_count"), data.alias("data"))
     .write.mode("overwrite").json(root))


def read_pages(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Landed pages → one row per record with the envelope columns. Lines split across tasks; a page
    without its list has no records."""
    spec = S.FEEDS[feed]
    pages = spark.read.schema(S.envelope_schema(spec["raw"], spec["nested_key"])).option("mode", "FAILFAST").json(path)
    items = F.col("data").getField(spec["nested_key"]) if spec["nested_key"] else F.col("data")
    return pages.select("source", "endpoint", S.STAMP, F.inline(items))


def read_envelopes(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Single-document envelopes → one row per record with the envelope columns.

    The stablecoin feed nests its list under ``data.peggedAssets``; a missing list
    yields no rows.
    """
    spec = S.FEEDS[feed]
    schema = S.envelope_schema(spec["raw"], spec["nested_key"])
    docs = (spark.read.schema(schema)
            .option("multiLine", True).option("mode", "FAILFAST").json(path))
    items = F.col("data")
    if spec["nested_key"]:
        items = F.col("data").getField(spec["nested_key"])
    return docs.select("source", "endpoint", S.STAMP, F.inline(items))


def envelope_manifest(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Per envelope: stamp and the number of records it carries (0 when absent)."""
    spec = S.FEEDS[feed]
    schema = S.envelope_schema(spec["raw"], spec["nested_key"])
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    items = F.col("data")
    if spec["nested_key"]:
        items = F.col("data").getField(spec["nested_key"])
    return docs.select("source", "endpoint", S.STAMP,
                       F.coalesce(F.array_size(items), F.lit(0)).cast("long").alias("record_count"))

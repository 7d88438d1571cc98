"""Fields that the allow-list doesn't know.

The normalisers keep a feed's known fields. A source that adds a field, renames one or stops
sending it is not noticed there: unknown fields are left out, missing ones are NULL. Here the names
of all top-level fields of the raw records are counted run by run, and the newest run is
compared with the one before and with the allow-list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.sources.landing import ATTEMPT, current_runs, run_folders

#: Fields that the landing adds to every record.
ENVELOPE = ("source", "endpoint")


def raw_fields(spark: SparkSession, root: str, stamps: list[str] | None = None) -> DataFrame:
    """``(ingested_at_utc, field, records)``: in how many records of a run a top-level field stands, a null value included.

    Counts are combined in the tasks before they are exchanged, so what is shuffled grows with the number of fields.
    """
    lines = spark.read.option("basePath", root).text(run_folders(spark, root, stamps)).drop(ATTEMPT)
    fields = lines.select(S.STAMP, F.explode(F.json_object_keys("value")).alias("field"))
    return fields.where(~F.col("field").isin(*ENVELOPE)).groupBy(S.STAMP, "field").agg(F.count(F.lit(1)).alias("records"))


def field_changes(fields: DataFrame, known: list[str], newest: str, previous: str | None) -> DataFrame:
    """``(field, change, records)`` of the newest run: ``unknown`` to the allow-list, ``new`` or ``vanished`` since the run before."""
    now, before = (fields.where(F.col(S.STAMP) == run) for run in (newest, previous or ""))
    both = now.select("field", "records").join(before.select("field", F.col("records").alias("earlier")), "field", "full_outer")
    unknown = F.col("records").isNotNull() & ~F.col("field").isin(*known)
    changes = F.array_compact(F.array(
        F.when(unknown, "unknown"),
        F.when(F.lit(previous is not None) & F.col("earlier").isNull(), "new"),
        F.when(F.col("records").isNull(), "vanished")))
    return both.select("field", F.explode(changes).alias("change"), F.coalesce("records", F.lit(0)).cast("long").alias("records"))


def feed_drift(spark: SparkSession, root: str, feed: str) -> DataFrame:
    """``field_changes`` of a feed's newest landed run, and the one before where there is one. Only these two are read."""
    runs = [stamp for stamp, records, _ in current_runs(spark, root) if records][-2:]
    if not runs:
        raise FileNotFoundError(f"{root}: no run with records was landed here")
    known = [f.name for f in S.FEEDS[feed]["raw"].fields]
    return field_changes(raw_fields(spark, root, runs), known, runs[-1], runs[0] if len(runs) > 1 else None)

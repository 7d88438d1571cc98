"""Ordering helpers: top-k and report orders.

An order is plain data — ``(("score", "desc"), ("id", "asc"), ...)`` — turned into
Columns only when a plan is built (Columns need an active session).

``with_global_position`` numbers all rows of an order without ever bringing them into one task.

``top_k`` is ``orderBy(...).limit(n)``, which Spark plans as
TakeOrderedAndProject: every task keeps its own n best rows and only those reach
the final merge — no global sort, no shuffle of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

Order = tuple[tuple[str, str], ...]


def report_order(desc_keys: Sequence[str], tie_breakers: Sequence[str]) -> Order:
    """Stated keys descending (NULLs last), then tie-breakers ascending (NULLs
    last) so that a limit picks the same rows on every run."""
    return tuple((k, "desc") for k in desc_keys) + tuple((k, "asc") for k in tie_breakers)


def order_sql(order: Order) -> str:
    """The order as a SQL ORDER BY list (NULLs last throughout)."""
    return ", ".join(f"{c} {d} nulls last" for c, d in order)


def order_columns(order: Order) -> list[Column]:
    return [F.desc_nulls_last(c) if d == "desc" else F.asc_nulls_last(c) for c, d in order]


def top_k(df: DataFrame, order: Order, n: int | None) -> DataFrame:
    """The first ``n`` rows by ``order``; ``n=None`` returns every row, unordered
    (order is applied at the sink)."""
    if n is None:
        return df
    return df.orderBy(*order_columns(order)).limit(n)


def ascending_by(df: DataFrame, key: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Re-sort a small, already limited frame ascending by ``key`` (bar-chart order)."""
    return df.orderBy(F.asc_nulls_last(key), *[F.asc_nulls_last(t) for t in tie_breakers])


def with_global_position(df: DataFrame, order: Sequence[Column], name: str = "position", path: str | None = None) -> DataFrame:
    """``df`` with each row's place, from 1, in ``order`` (LONG column ``name``); the result is read from ``path``.

    Rows are dealt into ranges of the order and sorted there; a row's place is the number of rows in the ranges before its
    own plus its place within. Only the number of rows of each range reaches the driver. Rows with equal keys take
    consecutive places in any order; a hash of the row's number parts them, so a key that many rows share is cut between
    ranges, too. Both the numbered and the sorted rows are written first: a repeated task then deals out the same rows.
    """
    spark = df.sparkSession
    root = path or scratch_path(spark, "positions")
    df.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id())).write.mode("overwrite").parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    (rows.orderBy(*order, "_tie").select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at"))
     .write.mode("overwrite").parquet(f"{root}/sorted"))
    placed = spark.read.parquet(f"{root}/sorted")
    before, starts = 0, []
    for r in placed.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first")).orderBy("_range").collect():
        starts.append((r["_range"], before - r["first"] + 1))  # one row for each range
        before += r["n"]
    if not starts:
        return placed.drop("_tie", "_range", "_at").withColumn(name, F.lit(None).cast("long"))
    offsets = F.broadcast(spark.createDataFrame(starts, "_range int, _start long"))  # a row for each range
    return placed.join(offsets, "_range").withColumn(name, F.col("_at") + F.col("_start")).drop("_tie", "_range", "_at", "_start")

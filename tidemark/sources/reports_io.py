"""Report files: CSV with a header row.

A report directory is written by Spark (one or more part files). Ranked reports
hold at most a few dozen rows and are written as one file; trend reports may be
large and keep their partitioning, with rows sorted within the global order.
Reading back always uses an explicit schema, and a CSV read back has no order —
callers re-state the order they need.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


class ReportMissing(FileNotFoundError):
    pass


def write_report(df: DataFrame, path: str, order: list[Column] | None = None,
                 single_file: bool = False, stage: str | None = None) -> None:
    """Write ``df`` as CSV, globally ordered by ``order`` when given.

    ``single_file`` funnels the report through one task: use it only for bounded
    reports (the top-50 ranked reports), never for trends or unlimited output.

    A global sort samples its input to choose ranges, which would compute ``df``
    twice; with ``stage`` (a folder in the shared file system) ``df`` is written
    once as parquet and the sort reads that instead — it also cuts the lineage,
    so a lost executor during the sort does not repeat the upstream join.
    """
    if order and stage and not single_file:
        df.write.mode("overwrite").parquet(stage)
        df = df.sparkSession.read.parquet(stage)
    out = df.orderBy(*order) if order else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").option("header", True).csv(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Read a report back. ``schema=None`` takes column names from the header and
    reads every column as text (used to check what a file really contains)."""
    # pandas writes infinities as "inf"/"-inf", Spark as "Infinity"/"-Infinity":
    # the first pair is named here, the second is understood by the number parser.
    reader = (spark.read.option("header", True).option("mode", "FAILFAST")
              .option("positiveInf", "inf").option("negativeInf", "-inf"))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", False)
    try:
        df = reader.csv(path)
        if schema is None:
            df.columns  # forces the header read, so a missing path fails here
        return df
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            raise ReportMissing(f"missing report: {path}") from exc
        raise


def preview(df: DataFrame, order, n: int = 15) -> DataFrame:
    """The first ``n`` rows in report order (top-k, no full sort)."""
    from tidemark.operators.ranking import top_k

    return top_k(df, order, n)

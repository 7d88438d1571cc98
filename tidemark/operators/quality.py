"""Output checks before publishing.

All present targets are counted by one aggregation over their tagged union (row
count, and for reports the count of non-NULL scores). A missing path or a missing
score column is caught when the plan is built and becomes a failed row. The
suite returns every result (not just the first failure); ``assert_passed``
raises listing all failures.

Table scans read no columns; report scores are counted as text (an empty CSV
field is NULL).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("target", T.StringType(), False),
    T.StructField("rows", T.LongType(), True),
    T.StructField("passed", T.BooleanType(), False),
    T.StructField("message", T.StringType(), True),
])


@dataclass(frozen=True)
class TableTarget:
    name: str
    path: str
    key: str | None = None  # the column that tells records apart, if its gaps and repeats are to be reported


@dataclass(frozen=True)
class ReportTarget:
    name: str
    path: str
    score_column: str


class QualityCheckFailed(ValueError):
    pass


def _is_missing(exc: AnalysisException) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def _is_without_files(exc: AnalysisException) -> bool:
    """A folder that exists but holds no data file (nothing to infer a schema from)."""
    return "UNABLE_TO_INFER_SCHEMA" in str(exc)


def _tagged(df: DataFrame, check: str, target: str, score: str | None) -> DataFrame:
    """One row per input row: (check, target, real, score-present)."""
    present = F.col(score).isNotNull() if score else F.lit(True)
    return df.select(F.lit(check).alias("check"), F.lit(target).alias("target"),
                     F.lit(1).alias("_real"), present.alias("_scored"))


def _open_table(spark: SparkSession, target: TableTarget):
    """(rows DataFrame, None, None) or (None, failure message, row count)."""
    try:
        return spark.read.parquet(target.path), None, None
    except AnalysisException as exc:
        if _is_missing(exc):
            return None, f"{target.name} was not written: nothing at {target.path}", None
        if _is_without_files(exc):
            return None, f"{target.name} holds no row at {target.path}", 0
        raise


def _open_report(spark: SparkSession, target: ReportTarget):
    try:
        df = spark.read.option("header", True).csv(target.path)
        columns = df.columns
    except AnalysisException as exc:
        if _is_missing(exc):
            return None, f"{target.name} was not written: nothing at {target.path}", None
        if _is_without_files(exc):
            return None, f"{target.name} holds no row at {target.path}", 0
        raise
    if target.score_column not in columns:
        return None, f"{target.name} lacks its score {target.score_column}; it has {len(columns)} other columns", None
    return df.select(target.score_column), None, None


def quality_suite(spark: SparkSession, tables: list[TableTarget], reports: list[ReportTarget]) -> DataFrame:
    """Q1-Q4: all checks as one DataFrame (check, target, rows, passed, message).

    Every present target contributes its rows (tagged) to one union, plus one
    marker row so that an empty target still appears; a single ``groupBy`` then
    counts rows and non-NULL scores for all targets in one job. Missing targets
    become failed rows without touching data.
    """
    markers, failures, parts, opened = [], [], [], []
    for t in tables:
        df, problem, rows_seen = _open_table(spark, t)
        if problem:
            failures.append(("table_not_empty", t.name, rows_seen, False, problem))
        else:
            markers.append(("table_not_empty", t.name))
            opened.append((t, df))
            parts.append(_tagged(df, "table_not_empty", t.name, None))
    for r in reports:
        df, problem, rows_seen = _open_report(spark, r)
        if problem:
            failures.append(("report_valid", r.name, rows_seen, False, problem))
        else:
            markers.append(("report_valid", r.name))
            parts.append(_tagged(df, "report_valid", r.name, r.score_column))
    failed = spark.createDataFrame(failures, RESULT_SCHEMA)
    if not parts:
        return failed
    tagged = spark.createDataFrame([(c, t, 0, False) for c, t in markers],
                                   "check string, target string, _real int, _scored boolean")
    for p in parts:
        tagged = tagged.unionByName(p)
    rows = F.sum("_real").cast("long")
    scored = F.count_if(F.col("_scored") & (F.col("_real") == 1))
    is_report = F.col("check") == "report_valid"
    counted = tagged.groupBy("check", "target").agg(rows.alias("rows"), scored.alias("_n_scored"))
    keyed = [_key_rows(df, t) for t, df in opened if t.key]
    checked = counted.select(
        "check", "target", "rows",
        ((F.col("rows") > 0) & (~is_report | (F.col("_n_scored") > 0))).alias("passed"),
        F.when(F.col("rows") == 0, F.concat(F.col("target"), F.lit(" holds no row")))
         .when(is_report & (F.col("_n_scored") == 0),
               F.concat(F.lit("none of the "), F.col("rows").cast("string"), F.lit(" rows of "), F.col("target"), F.lit(" has a score")))
         .alias("message"))
    for own in keyed:
        checked = checked.unionByName(own)
    return checked.unionByName(failed)


def _key_rows(df: DataFrame, target: TableTarget) -> DataFrame:
    """Two rows that always pass: how many records have no key (they join nothing), and how many have one
    that another record has, too (they multiply in a join)."""
    per_key = df.groupBy(F.col(target.key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    found = per_key.agg(
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_n"))), F.lit(0)).alias("none"),
        F.coalesce(F.sum(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("repeated"))
    rows = F.array(*[F.struct(F.lit(check).alias("check"), F.col(c).cast("long").alias("rows"), F.lit(text).alias("message"))
                     for check, c, text in (("ids_missing", "none", "records without an id"),
                                            ("ids_repeated", "repeated", "records whose id another one has"))])
    return found.select(F.inline(rows)).select(
        "check", F.lit(target.name).alias("target"), "rows", F.lit(True).alias("passed"),
        F.when(F.col("rows") > 0, F.col("message")).alias("message"))


def assert_passed(results: DataFrame) -> DataFrame:
    """Run the checks once; raise listing every failure, else return the (few) result rows as a frame."""
    rows = results.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityCheckFailed("; ".join(f"{r['target']}: {r['message']}" for r in failed))
    return results.sparkSession.createDataFrame(rows, RESULT_SCHEMA)

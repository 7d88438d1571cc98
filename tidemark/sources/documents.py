"""Whole-document envelopes, read by many tasks.

An envelope is one JSON document, ``{source, endpoint, ingested_at_utc, record_count, data: [...]}``.
A JSON reader takes such a document in one task. Here its bytes are read in ranges, as any other
large file's are, and the records' boundaries are found in parallel:

* A task reads the rows of a range in the order of the file, so it follows the parser's state
  through them, and no text is exchanged.
* A range of the file is summarised as a function of the parser's state at its start: the quotes
  it holds turn "in a string" over or not, and it changes the depth by one number if it starts
  outside a string and by another one if inside. (A range never starts behind a lone backslash,
  as JSON escapes no bracket.) Composing these few numbers in file order gives every range's
  start state; the lists a range starts in follow in the same way, level by level.
* Each range then tells its own records. The pieces of a record that crosses a range's end
  meet in one small exchange.

The text is read once for the state, once for each level of lists, once for the records that lie in one range and once for
the others; of the passes before only a row for each range is kept. A group is one record that crosses ranges. A document may also lie in several files that
follow each other by name, each ending with a closing brace (``land_documents`` writes such ones),
so writing a large one takes many tasks, too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.session import importable, scratch_path

_RANGE = ["file", "start"]
_ESCAPED = re.compile(r"\\.", re.S)
_STRING_END = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
_TOKEN = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|["\[\]{}]', re.S)
#: Records a task returns at a time.
_BATCH = 1_000
#: Records of one landed file, about.
FILE_RECORDS = 100_000


def _document(in_parts: bool) -> Column:
    return (F.regexp_replace("file", "/[^/]*$", "") if in_parts else F.col("file")).alias("document")


def _pieces(spark: SparkSession, path: str, in_parts: bool) -> DataFrame:
    """``(document, file, start, row, text)``: the text up to each closing brace, ``start`` telling the range of the file."""
    rows = (spark.read.schema("value string").option("lineSep", "}").option("recursiveFileLookup", True).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("row"), F.concat("value", F.lit("}")).alias("text")))
    return rows.select(_document(in_parts), "*")


# --- in the tasks: a range's rows in order ---------------------------------------------

def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Each range's key and rows. Rows that don't come as they were read fail the job."""
    def rows() -> Iterator[dict]:
        before = -1
        for batch in batches:
            for row in batch.to_pylist():
                if row["row"] <= before:
                    raise RuntimeError("a range's rows aren't in the order of the file")
                before = row["row"]
                yield row
    return groupby(rows(), key=lambda row: (row["file"], row["start"]))


def _balance(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _brackets(text: str, inside: bool) -> tuple[list[int], bool]:
    """Where brackets outside strings end, and whether the text ends in a string."""
    at = 0
    if inside:
        end = _STRING_END.match(text)
        if end is None:
            return [], True
        at = end.end()
    found = []
    for token in _TOKEN.finditer(text, at):
        if token.end() - token.start() == 1:
            if token.group() == '"':
                return found, True
            found.append(token.end())
    return found, False


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: its quotes (escaped ones don't count) and its change of depth, should it start outside a string or inside one."""
    out = []
    for (file, start), rows in _ranges(batches):
        quotes, change = 0, [0, 0]
        for row in rows:
            text = row["text"]
            parts = (_ESCAPED.sub("", text) if "\\" in text else text).split('"')
            for k in (0, 1):
                change[(quotes + k) % 2] += _balance("".join(parts[k::2]))
            quotes += len(parts) - 1
        out.append({"file": file, "start": start, "quotes": quotes, "if_outside": change[0], "if_inside": change[1]})
    yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), *((c, pa.int64()) for c in ("start", "quotes", "if_outside", "if_inside"))]))


def _opened(text: str, keys: list[str], depth: int, lists: list[int]) -> None:
    """Note in ``lists`` that the bracket at the end of ``text`` opened ``depth``: whether it is the next list of the path."""
    k = depth - 2
    if 0 <= k < len(keys):
        named = re.search(rf'(?s)(^|[^\\])"{keys[k]}"\s*:\s*[\[\{{]$', text)
        lists[k] = int(bool(named) and (k == 0 or lists[k - 1] == 1))


def _tells(keys: list[str], depth_of_list: int) -> Callable:
    """Per range: ``told``, whether it ends within the lists of ``keys`` (NULL if no bracket tells), the objects that ``ended`` at the
    list's depth, and ``outer``, the text at the document's first level; what is nested there is left out."""
    last = len(keys) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (file, start), rows in _ranges(batches):
            depth, ended, told, outer = None, 0, None, []
            for row in rows:
                if depth is None:
                    depth, inside, lists = row["depth"], row["inside"] == 1, [row.get(f"start_{k}") or 0 for k in range(len(keys))]
                text, at = row["text"], 0
                found, inside = _brackets(text, inside)
                for end in found:
                    opens = text[end - 1] in "[{"
                    if depth == 1:
                        outer.append(text[at:end - 1] + ("null" if opens else ""))
                    depth += 1 if opens else -1
                    ended += not opens and depth == depth_of_list
                    lists[max(depth - 1, 0):] = [0] * len(lists[max(depth - 1, 0):])
                    if opens:
                        _opened(text[at:end], keys, depth, lists)
                    if keys and (depth < last + 2 or (opens and depth == last + 2)):
                        told = lists[last]
                    at = end
                if depth == 1:
                    outer.append(text[at:])
            out.append({"file": file, "start": start, "told": told, "ended": ended, "outer": "".join(outer)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("start", pa.int64()), ("told", pa.int32()), ("ended", pa.int64()), ("outer", pa.string())]))
    return run


def _tellings(keys: list[str], crossing: bool) -> Callable:
    """The records' texts: of those that lie in the range, or (``crossing``) the parts of those that don't, ``ended`` where the last one is.
    ``number`` counts the objects that ended before at the list's depth."""
    depth_of_list, schema = len(keys) + 1, pa.schema([("file", pa.string()), ("start", pa.int64()), ("number", pa.int64()), ("text", pa.string()), ("ended", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def tell(ended: bool) -> None:
            whole = ended and not (within and number == ends)
            if parts and whole != crossing:
                out.append({"file": file, "start": start, "number": number, "text": "".join(parts), "ended": ended})
            parts.clear()

        for (file, start), rows in _ranges(batches):
            depth, parts = None, []
            for row in rows:
                if depth is None:
                    depth, inside, lists = row["depth"], row["inside"] == 1, [row[f"start_{k}"] for k in range(len(keys))]
                    within, ends = depth > depth_of_list or inside, row["ends"]
                    number = ends
                text, at = row["text"], 0
                found, inside = _brackets(text, inside)
                for end in found:
                    opens, own = text[end - 1] in "[{", lists[-1] == 1
                    depth += 1 if opens else -1
                    lists[max(depth - 1, 0):] = [0] * len(lists[max(depth - 1, 0):])
                    if opens:
                        _opened(text[at:end], keys, depth, lists)
                    if own:  # the bracket that closes the list is no part of a record
                        parts.append(text[at:end if depth >= depth_of_list else end - 1])
                    if not opens and depth == depth_of_list:
                        if own:
                            tell(True)
                        number += 1
                    at = end
                if lists[-1] == 1:
                    parts.append(text[at:])
                if len(out) >= _BATCH:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
            tell(False)
        yield pa.RecordBatch.from_pylist(out, schema)
    return run


# --- ranges of a document, in its order ---------------------------------------------------

def _before(column: str) -> Column:
    """Sum over the document's earlier ranges: a row for each range of the file is summed."""
    order = Window.partitionBy("document").orderBy(*_RANGE)
    return F.coalesce(F.sum(column).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _noted(ranges: DataFrame) -> DataFrame:
    """What is known of the ranges, a row each, written and read again: later passes don't repeat the earlier ones."""
    path = scratch_path(ranges.sparkSession, "document-ranges")
    ranges.write.parquet(path)
    return ranges.sparkSession.read.schema(ranges.schema).parquet(path)


def _starts(pieces: DataFrame, in_parts: bool) -> DataFrame:
    """Every range's start state: in a string or not (1 or 0), and the depth."""
    importable(pieces.sparkSession)
    ranges = pieces.drop("document").mapInArrow(_parities, "file string, start long, quotes long, if_outside long, if_inside long").withColumn("document", _document(in_parts))
    known = ranges.withColumn("inside", _before("quotes") % 2)
    known = known.withColumn("change", F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside")))
    return _noted(known.select("document", *_RANGE, "inside", _before("change").alias("depth")))


def _placed(pieces: DataFrame, starts: DataFrame) -> DataFrame:
    """Pieces with their range's start state; they stay where they were read, as the ranges' rows are brought to them."""
    return pieces.drop("document").join(F.broadcast(starts.drop("document")), _RANGE)


def _told(pieces: DataFrame, starts: DataFrame, keys: list[str], depth_of_list: int) -> DataFrame:
    told = _placed(pieces, starts).mapInArrow(_tells(keys, depth_of_list), "file string, start long, told int, ended long, outer string")
    return _noted(told.join(F.broadcast(starts.select("document", *_RANGE)), _RANGE))


def _with_lists(pieces: DataFrame, starts: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The start states with ``start_k``, whether a range starts within the path's first keys, and ``ends``, the objects that
    ended at the list's depth in the document's earlier ranges; and the ranges' ``outer`` text."""
    earlier = Window.partitionBy("document").orderBy(*_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    for k in range(len(keys)):
        told = _told(pieces, starts, keys[:k + 1], len(keys) + 1)
        known = told.select(*_RANGE, F.coalesce(F.last("told", ignorenulls=True).over(earlier), F.lit(0)).alias(f"start_{k}"), _before("ended").alias("ends"))
        starts = _noted(starts.drop("ends").join(known, _RANGE))
    return starts, told


def _joined(parts: Column) -> Column:
    """Pieces, gathered as (order, text) structs, as one text."""
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p["text"]), "")


def _texts(placed: DataFrame, keys: list[str], in_parts: bool) -> DataFrame:
    """``(document, text)``: each record's own text."""
    schema = "file string, start long, number long, text string, ended boolean"
    whole, crossing = (placed.mapInArrow(_tellings(keys, c), schema).withColumn("document", _document(in_parts)) for c in (False, True))
    rest = crossing.groupBy("document", "number").agg(F.collect_list(F.struct(*_RANGE, "text")).alias("parts"), F.max("ended").alias("ended"))
    return whole.select("document", "text").unionByName(rest.where("ended").select("document", _joined(F.col("parts")).alias("text")))


def _envelopes(told: DataFrame) -> DataFrame:
    """``(document, source, endpoint, ingested_at_utc, record_count)`` from the text at the documents' first level."""
    joined = F.concat(F.lit("{"), _joined(F.collect_list(F.struct(*_RANGE, F.col("outer").alias("text")))), F.lit("}"))
    fields = f"source string, endpoint string, {S.STAMP} string, record_count long"
    return told.groupBy("document").agg(F.from_json(joined, fields, {"mode": "FAILFAST"}).alias("e")).select("document", "e.*")


def read_documents(spark: SparkSession, path: str, feed: str, in_parts: bool = False) -> DataFrame:
    """Envelope documents → one row per record with the envelope columns, as ``read_pages`` gives them.

    ``path`` is a file or a folder of them. ``in_parts``: all files of one folder are one document, in the order of their
    names. The fields of an envelope may stand before or behind its list; a document without its list has no records, and
    entries of the list that are no objects are left out. A broken record fails the job.
    """
    spec = S.FEEDS[feed]
    keys = ["data"] + ([spec["nested_key"]] if spec["nested_key"] else [])
    pieces = _pieces(spark, path, in_parts)
    starts, told = _with_lists(pieces, _starts(pieces, in_parts), keys)
    texts = _texts(_placed(pieces, starts), keys, in_parts)
    record = F.from_json(F.regexp_replace("text", r"^[^\{]*", ""), spec["raw"], {"mode": "FAILFAST"}).alias("r")
    envelopes = _envelopes(told).drop("record_count")
    return texts.select("document", record).join(envelopes, "document").select("source", "endpoint", S.STAMP, "r.*")


def document_manifest(spark: SparkSession, path: str, in_parts: bool = False) -> DataFrame:
    """Per document: source, endpoint, run stamp and the record count its envelope states."""
    pieces = _pieces(spark, path, in_parts)
    return _envelopes(_told(pieces, _starts(pieces, in_parts), [], 0)).drop("document")


def land_documents(records: DataFrame, root: str, feed: str, source: str, endpoint: str, order: Column, stamp: Column,
                   parts: int | None = None) -> None:
    """Land one document for each run, its records in ``order`` (unique in a run), in a folder ``run=<stamp>`` of parts.

    Runs are cut into ranges of records, a file each, so many tasks write one document; ``parts`` is the least number of
    ranges over all runs. There are more where a range would hold over ``FILE_RECORDS`` records.
    """
    nested = S.FEEDS[feed]["nested_key"]
    own = records.select(stamp.alias("run"), order.alias("at"), F.to_json(F.struct(*[c for c in records.columns if c != S.STAMP])).alias("text"))
    runs = _noted(own.groupBy("run").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")))  # a row for each run
    parts = max(parts or 1, -(-(runs.agg(F.sum("n")).first()[0] or 0) // FILE_RECORDS))
    head = F.concat(F.lit(f'{{"source": "{source}", "endpoint": "{endpoint}", "{S.STAMP}": "'), F.col("run"), F.lit('", "record_count": '),
                    F.col("n").cast("string"), F.lit(', "data": ' + (f'{{"{nested}": [' if nested else "[")))
    lead = F.when(F.col("at") == F.col("first"), head).otherwise(F.lit(",\n"))
    # The writer's line end is the brace that closes a record, or the document.
    lines = own.join(F.broadcast(runs), "run").select("run", F.lit(0).alias("tail"), "at", F.expr("left(text, length(text) - 1)").alias("text"), lead.alias("lead")) \
        .select("run", "tail", "at", F.concat("lead", "text").alias("value"))
    tails = runs.select("run", F.lit(1).alias("tail"), F.col("first").alias("at"), F.lit("]}" if nested else "]").alias("value"))
    (lines.unionByName(tails).repartitionByRange(parts, "run", "tail", "at").sortWithinPartitions("run", "tail", "at").select("run", "value")
     .write.mode("overwrite").partitionBy("run").option("lineSep", "}").text(root))

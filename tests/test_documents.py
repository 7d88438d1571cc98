"""One JSON document read by many tasks, against the standard parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.sources import documents
from tidemark.sources.landing import read_envelopes

STAMP = "20240101T000000Z"
TRICKY = ['plain', 'a "quoted" part', 'braces {[}] inside', 'back\\slash', 'ends with \\', '"', '\\"', '}{', '][', '"data": [', '"data": [{', 'é 日本 😀',
          'new\nline\ttab', '', ' ', '\\\\', '{"id": "x"}']


def envelope(records, nested=None, first=True, **more):
    data = {nested: records, "chains": [{"name": "not a record", "tvl": {"a": [1]}}]} if nested else records
    head = {"source": "some source", "endpoint": "https://a.b/{c}[d]?\"x\"", S.STAMP: STAMP, "record_count": len(records)}
    other = {"other": {"data": [{"id": "nested elsewhere"}], "peggedAssets": [{"id": 1}]}, "notes": [{"id": "x"}, [{"id": "y"}]], "empty": {}, "none": []}
    return {**head, "data": data, **other, **more} if first else {**other, **more, "data": data, **head}


def records_of(rng, n, feed):
    out = []
    for k in range(n):
        r = {"id": str(k), "name": rng.choice(TRICKY), "symbol": rng.choice([None, rng.choice(TRICKY)]), "unknown": {"deep": [{"x": [rng.choice(TRICKY)]}, []]}}
        if feed == "stablecoins":
            r |= {"circulating": {"peggedUSD": k + 0.5}, "chains": [rng.choice(TRICKY) for _ in range(k % 4)], "pegType": "peggedUSD"}
        out.append(r)
    rng.shuffle(out)
    return out


def rows_of(df):
    text = [F.col(c).cast("string").alias(c) if c in S.VARIANT_FIELDS else F.col(c) for c in df.columns]
    return sorted((tuple(r) for r in df.select(*text).collect()), key=repr)


@pytest.fixture
def small_ranges(spark):
    """Ranges of so few bytes that most records cross some."""
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("feed, size, indent, first", [
    ("markets", 97, None, True), ("markets", 1000, 2, True), ("markets", 64, 2, False), ("protocols", 1 << 20, None, False),
    ("stablecoins", 97, None, True), ("stablecoins", 333, 2, False)])
def test_every_record_of_a_document(spark, tmp_path, small_ranges, feed, size, indent, first):
    rng = random.Random(size)
    nested = S.FEEDS[feed]["nested_key"]
    for k, ensure in enumerate((True, False)):
        doc = envelope(records_of(rng, 40, feed), nested, first)
        (tmp_path / f"doc{k}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=ensure), encoding="utf-8")
    whole = rows_of(read_envelopes(spark, str(tmp_path), feed))
    small_ranges(size)
    pieces = documents._pieces(spark, str(tmp_path), False)
    if size < 2000:
        assert pieces.select("file", "start").distinct().count() > 8  # several ranges a file
    found = documents.read_documents(spark, str(tmp_path), feed)
    assert found.columns == read_envelopes(spark, str(tmp_path), feed).columns
    assert rows_of(found) == whole and len(whole) == 80


@pytest.mark.parametrize("doc", [envelope([]), envelope([], "peggedAssets"), {"source": "s"}, envelope([{"id": "1"}]) | {"data": None},
                                 envelope([{"id": "1"}]) | {"data": {"x": 1}}])
def test_documents_without_records(spark, tmp_path, doc):
    (tmp_path / "doc.json").write_text(json.dumps(doc) + "\n")
    assert documents.read_documents(spark, str(tmp_path), "stablecoins" if "peggedAssets" in str(doc.get("data")) else "markets").count() == 0
    row = documents.document_manifest(spark, str(tmp_path)).first()
    assert row.source == doc["source"] and row.record_count == doc.get("record_count")


def test_entries_that_are_no_objects(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps(envelope([None, {"id": "1"}, 3, {"id": "2"}, {}])))
    found = documents.read_documents(spark, str(tmp_path), "markets")
    assert sorted((r.id or "") for r in found.select("id").collect()) == ["", "1", "2"]


def test_a_document_in_parts(spark, tmp_path, small_ranges):
    rng = random.Random(1)
    made = [(f"2024010{1 + k % 2}T000000Z", k, rng.choice(TRICKY)) for k in range(60)]
    df = spark.createDataFrame(made, f"{S.STAMP} string, n int, name string").select(F.col("n").cast("string").alias("id"), "name", S.STAMP)
    documents.land_documents(df, f"{tmp_path}/docs", "protocols", "src", "end", F.col("id").cast("int"), F.col(S.STAMP), parts=6)
    assert len(list((tmp_path / "docs").glob("run=20240101*/part-*"))) > 1
    small_ranges(150)
    found = documents.read_documents(spark, f"{tmp_path}/docs", "protocols", in_parts=True)
    assert sorted((r[S.STAMP], int(r.id), r.name) for r in found.collect()) == sorted(made)
    counts = documents.document_manifest(spark, f"{tmp_path}/docs", in_parts=True).collect()
    assert sorted((r[S.STAMP], r.record_count, r.source) for r in counts) == [("20240101T000000Z", 30, "src"), ("20240102T000000Z", 30, "src")]
    for part in sorted((tmp_path / "docs").glob("run=20240101*")):
        assert len(json.loads("".join(p.read_text() for p in sorted(part.glob("part-*"))))["data"]) == 30


def test_text_is_exchanged_only_for_records_that_cross_ranges(spark, tmp_path, small_ranges):
    """The state follows the rows where they were read: no window, which would bring each range's text together."""
    rng = random.Random(2)
    (tmp_path / "doc.json").write_text(json.dumps(envelope(records_of(rng, 40, "markets"))))
    small_ranges(400)
    found = documents.read_documents(spark, str(tmp_path), "markets")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 2  # crossing records and the envelopes
    assert found.count() == 40


def test_rows_out_of_order_fail():
    batch = documents.pa.RecordBatch.from_pylist([{"file": "f", "start": 0, "row": n, "text": "}"} for n in (1, 2, 2)])
    with pytest.raises(RuntimeError, match="order"):
        [list(rows) for _, rows in documents._ranges([batch])]


def test_files_of_a_landed_document_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "FILE_RECORDS", 10)
    df = spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(STAMP).alias(S.STAMP))
    documents.land_documents(df, f"{tmp_path}/docs", "markets", "src", "end", F.col("id").cast("int"), F.col(S.STAMP), parts=2)
    sizes = [p.read_text().count('"id"') for p in sorted((tmp_path / "docs").glob("run=*/part-*"))]
    assert sum(sizes) == 200 and max(sizes) < 40
    assert documents.read_documents(spark, f"{tmp_path}/docs", "markets", in_parts=True).count() == 200


def test_broken_records_fail(spark, tmp_path):
    (tmp_path / "doc.json").write_text('{"source": "s", "data": [{"id": "1" "name"}, {"id": "2"}]}')
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        documents.read_documents(spark, str(tmp_path), "markets").collect()

"""Shards of nearly equal bytes, whole and gapless."""

import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import sharding
from tidemark.llm.queries import QUERIES

from .conftest import SF


def placed(df, shards=8):
    return sharding.shard_documents(df, shards, ["doc_id", "text"]).collect()


def check(rows, pairs, shards=8):
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(pairs)
    assert all(r.size == size(r.text) for r in rows)
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    total, largest = sum(map(size, (t for _, t in pairs))), max(map(size, (t for _, t in pairs)))
    for k in range(shards):
        own = sum(r.size for r in rows if r["shard"] == k)
        assert abs(own - total / shards) <= largest + 2 * sharding.TOLERANCE * total / shards


def test_query_covers_the_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op1_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        text = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "bytes", None)
    check([type("R", (), {"__getitem__": lambda s, k: getattr(s, k), "doc_id": r.doc_id, "text": docs[r.doc_id], "size": r.size,
                          "shard": r.shard, "slot": r.slot})() for r in rows], list(docs.items()))


def test_nulls_empty_repeated_long_and_a_hot_group(documents):
    pairs = [(i, f"text {i} " * (i % 7 + 1)) for i in range(120)] + [(None, None), (1, None), (2, ""), (5, "ä" * 4000)]
    pairs += [(1000 + i, "the same passage") for i in range(200)] + [(7, "twice")] * 40
    check(placed(documents(pairs)), pairs)


def test_equal_texts_lie_together_unless_cut(documents):
    pairs = [(i, f"text {i % 40}") for i in range(400)]
    homes = defaultdict(set)
    for r in placed(documents(pairs)):
        homes[r.text].add(r["shard"])
    assert sum(len(s) - 1 for s in homes.values()) <= 7


@pytest.mark.parametrize("pairs", [[], [(1, "one")], [(1, None)] * 3])
def test_few_rows(documents, pairs):
    rows = placed(documents(pairs))
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(pairs)


@pytest.mark.parametrize("rows, texts", [(300, 300), (60_000, 6_000)])
def test_slots_follow_the_key_at_every_size(spark, rows, texts):
    """Equal texts take neighbouring slots unless a shard's end parts them."""
    df = spark.range(rows, numPartitions=7).selectExpr("id as doc_id", f"concat('text ', id % {texts}) as text")
    out = sharding.shard_documents(df, 8, ["doc_id", "text"]).collect()
    assert Counter(r.doc_id for r in out) == Counter(range(rows))
    runs, last = Counter(), None
    for r in sorted(out, key=lambda r: (r["shard"], r.slot)):
        if (r["shard"], r.text) != last:
            runs[r.text] += 1
        last = (r["shard"], r.text)
    assert len(runs) == texts and sum(n - 1 for n in runs.values()) <= 7
    check(out, [(i, f"text {i % texts}") for i in range(rows)])


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(k, f"t{k}", "a", "b", "c", 1, 2, "d") for k in range(30)],
                               "doc_id long, text string, key string, seq string, row string, size int, slot int, place string")
    out = sharding.shard_documents(df, 4, df.columns)
    assert out.columns == ["doc_id", "text", "key", "seq", "row", "place", "size", "shard", "slot"]
    assert {(r.key, r.seq, r.row, r.place) for r in out.collect()} == {("a", "b", "c", "d")}


def test_files_hold_all_rows(spark, documents, tmp_path):
    df = documents([(i, f"text {i}") for i in range(50)]).drop("shard")
    sharding.write_shards(df, 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(50)) and set(df.columns) < set(back.columns)

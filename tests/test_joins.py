"""J1: rows meet their own earlier row, rows without a key meet none, duplicates multiply."""

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.operators.joins import keyed_join
from tidemark.operators.normalize import normalize_protocols
from tidemark.operators.trends import compare_snapshots, defi_protocol_risk_trends


def _frames(spark, left_keys, right_keys, key_type="string"):
    left = spark.createDataFrame([(k, f"l{i}") for i, k in enumerate(left_keys)], f"id {key_type}, lv string")
    right = spark.createDataFrame([(k, f"r{i}") for i, k in enumerate(right_keys)], f"id {key_type}, rv string")
    return left, right


def test_null_keys_match_nothing(spark):
    left, right = _frames(spark, ["1", None, None, "2"], ["1", None, None])
    out = keyed_join(left, right, "id")
    assert out.columns == ["id", "lv", "rv"]
    assert [tuple(r) for r in out.collect()] == [("1", "l0", "r0")]


def test_duplicates_multiply(spark):
    left, right = _frames(spark, ["a", "a"], ["a", "a"])
    assert keyed_join(left, right, "id").count() == 4


def test_overlapping_columns_get_suffixes(spark):
    df = spark.createDataFrame([("a", 1.0)], "id string, v double")
    assert compare_snapshots(df, df.withColumn("only", F.lit(1))).columns == ["id", "v_latest", "v_previous", "only"]


def _run(spark, ids, stamp):
    raw = spark.createDataFrame([(i, f"n{k}", "5", stamp) for k, i in enumerate(ids)], f"id string, name string, tvl string, {S.STAMP} string")
    return normalize_protocols(raw)


def test_ids_that_are_no_numbers_meet_only_themselves(spark):
    ids = ["7", "7.50", "parent#a", " parent#b ", None, "", "x"]
    latest, previous = _run(spark, ids, "20240102T000000Z"), _run(spark, ["7.0", "7.5", "parent#a", "parent#b", None, "", "y"], "20240101T000000Z")
    assert [r[S.ID_TEXT] for r in latest.collect()] == ["7.0", "7.5", "parent#a", "parent#b", None, None, "x"]
    assert sorted(r["name_latest"] for r in defi_protocol_risk_trends(latest, previous).collect()) == ["n0", "n1", "n2", "n3"]


def test_output_grows_with_the_input_for_ids_that_are_no_numbers(spark):
    counts = []
    for n in (30, 300):
        ids = [f"parent#{k}" for k in range(n)] + [None] * n
        counts.append(defi_protocol_risk_trends(_run(spark, ids, "20240102T000000Z"), _run(spark, ids, "20240101T000000Z")).count())
    assert counts == [30, 300]


def test_hot_key_plan_is_one_equi_join(spark):
    left, right = _frames(spark, ["a"] * 30 + ["b"], ["a", "b"])
    plan = keyed_join(left, right, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "Generate" not in plan


def test_null_keys_meet_on_request_with_a_warning(spark):
    left, right = _frames(spark, ["1", None, None, "2"], ["1", None, None, None])
    with pytest.warns(UserWarning, match="6 rows of the join"):
        out = keyed_join(left, right, "id", nulls_meet=True)
    assert out.columns == ["id", "lv", "rv"] and out.count() == 7


def test_null_keys_meet_in_blocks(spark, monkeypatch):
    """Every pair once, repeated rows included, whatever the size of a block."""
    from tidemark.operators import joins

    monkeypatch.setattr(joins, "BLOCK_ROWS", 3)
    left, right = _frames(spark, ["1"] + [None] * 17, ["1", "3"] + [None] * 11)
    left, right = left.withColumn("lv", F.nullif(F.substring("lv", 1, 2), F.lit("l9"))), right.withColumn("rv", F.struct("rv"))
    with pytest.warns(UserWarning, match="187 rows of the join"):
        out = keyed_join(left, right, "id", nulls_meet=True)
    on_driver = [(l.id, l.lv, r.rv) for l in left.collect() for r in right.collect() if l.id == r.id]
    key = lambda row: tuple(map(str, row))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(on_driver, key=key)
    assert out.schema["rv"].dataType == right.schema["rv"].dataType


def test_null_keys_are_met_by_many_tasks(spark):
    """No task has a large part of the pairs."""
    left, right = _frames(spark, [None] * 6000, [None] * 5000)
    with pytest.warns(UserWarning, match="30000000 rows"):
        out = keyed_join(left, right, "id", nulls_meet=True)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(sizes) == 30_000_000 and max(sizes) <= 12_000_000


def test_large_whole_ids_stay_apart(spark):
    ids = ["9007199254740992", "9007199254740993", " +009007199254740993", "9007199254740993.0", "-9007199254740993", "12345678901234567890123"]
    assert [r[S.ID_TEXT] for r in _run(spark, ids, "20240102T000000Z").collect()] == [
        "9007199254740992", "9007199254740993", "9007199254740993", "9007199254740993", "-9007199254740993", "12345678901234567890123"]

"""Places in a global order, without one task that holds all rows."""

import random

from pyspark.sql import functions as F

from tidemark.operators.ranking import with_global_position


def test_positions_of_a_total_order(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(50), rng.choice([None, 1.5, -2.0, float("inf")]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b double, k int").repartition(6)
    out = with_global_position(df, [F.desc_nulls_last("a"), F.asc_nulls_last("b"), F.asc("k")])
    assert out.columns == ["a", "b", "k", "position"]
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    assert [tuple(r) for r in out.orderBy("position").collect()] == [(*r, n + 1) for n, r in enumerate(want)]


def test_a_key_of_most_rows_is_cut_between_ranges(spark):
    df = spark.range(20_000, numPartitions=6).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(7)).alias("a"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be merged
    try:
        out = with_global_position(df, [F.asc("a")], "place")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    places = [r.place for r in out.orderBy("place").collect()]
    assert places == list(range(1, 20_001))
    rows = out.where("a = 7").select(F.input_file_name().alias("f")).groupBy("f").count().collect()
    assert len(rows) > 2  # several ranges hold the common key


def test_no_rows(spark):
    out = with_global_position(spark.createDataFrame([], "a int"), [F.asc("a")])
    assert out.schema["position"].dataType.simpleString() == "bigint" and out.count() == 0

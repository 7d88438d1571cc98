"""Hard negatives against brute force, with ties, hot labels, odd vectors and several blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives
from tidemark.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, score string, kind string, anchor_id int"


def brute(rows, by=100, positives=5, per=10, scale=256):
    own = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
           if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked, out = {}, []
    for i, label, v in sorted(own, key=lambda r: (r[0], r[2], r[1])):
        if i % by == 0:
            asked.setdefault(i, (label, v))
    for a, (label, q) in asked.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v)), j, other == label) for j, other, v in own if j != a and len(v) == len(q))
        for negative_p, p, _ in [s for s in scored if s[2]][:positives]:
            fits = [(j, -s) for s, j, same in scored if not same and 30 * -negative_p <= 100 * -s <= 90 * -negative_p]
            out += [(a, p, n + 1, j, -negative_p, s) for n, (j, s) in enumerate(fits[:per])]
    return sorted(out)


def found(spark, rows, by=100, positives=5, per=10, parts=5):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(parts)
    mined = hard_negatives.mine_hard_negatives(df, lambda i: F.pmod(i, F.lit(by)) == 0, positives, per)
    return sorted(map(tuple, mined.collect()))


def made(n=240, dim=4, labels=3, seed=1, spread=1.0):
    rng = random.Random(seed)
    return [(i, [rng.randrange(-8, 9) / 16 * spread for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


def test_query(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op13_hard_negatives"](spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


@pytest.mark.parametrize("block, scores", [(4096, 1 << 19), (3, 20), (1, 1)])
def test_ties_hot_rows_and_odd_vectors(spark, monkeypatch, block, scores):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "SCORES_AT_A_TIME", scores)
    rows = made() + [(1000 + k, [0.5, 0.5, 0.5, 0.5], 0) for k in range(60)] + [(1100 + k, [0.25, 0.5, 0.25, 0.25], 1) for k in range(60)]
    rows += [(None, [1.0] * 4, 1), (2000, None, 1), (2040, [1.0] * 4, None), (2080, [1.0, None, 0.0, 0.0], 1), (2120, [math.nan] * 4, 1),
             (2160, [math.inf] * 4, 2), (2200, [0.25, 0.5], 0), (2201, [0.5, 0.5], 0), (2202, [0.25, 0.25], 1), (2240, [], 1), (2241, [], 1),
             (2242, [], 2), (-40, [0.1] * 4, 1), (40, made()[40][1], 2), (7, [0.5] * 4, 0), (7, [0.5] * 4, 0), (7, [0.5] * 4, 1), (2280, [0.0] * 4, 0)]
    assert found(spark, rows, 40, 4, 6) == brute(rows, 40, 4, 6)


def test_zero_and_negative_positives(spark):
    """A positive of score 0 has the window [0, 0], also for negatives with smaller ids; one below 0 has none."""
    rows = [(0, [1.0, 0.0], 0), (50, [0.0, 1.0], 0), (51, [-1.0, 0.0], 0), (1, [0.0, 0.5], 1), (99, [0.0, -0.5], 1), (2, [-0.5, 0.0], 1), (3, [0.25, 0.0], 1)]
    assert found(spark, rows) == brute(rows) == [(0, 50, 1, 1, 0, 0), (0, 50, 2, 99, 0, 0)]


def test_large_components_are_exact(spark):
    rows = made(80, 4, 3, 2, 2.0**18)
    assert found(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("n", [0, 1, 2, 9])
def test_few_rows(spark, n):
    rows = made(n)
    assert found(spark, rows, 2) == brute(rows, 2)


def test_window_must_lie_below(spark):
    df = spark.createDataFrame(made(5), "vec_id long, embedding array<float>, label int")
    with pytest.raises(ValueError):
        hard_negatives.mine_hard_negatives(df, lambda i: i == 0, low=30, high=100)


def test_pairs_shuffle_by_the_whole_key(spark):
    df = spark.createDataFrame(made(50), "vec_id long, embedding array<float>, label int")
    plan = hard_negatives.mine_hard_negatives(df, lambda i: F.pmod(i, F.lit(10)) == 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [anchor_id" in plan and "Sort [anchor_id" in plan and "score" in plan.split("Sort [anchor_id")[1][:60]

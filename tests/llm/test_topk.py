"""Top-k against brute force, with ties, odd vectors and several blocks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk
from tidemark.llm.queries import QUERIES

from .conftest import SF

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, by=100, k=10):
    own = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    asked = {}
    for i, v in sorted(own, key=lambda r: (r[0], r[1])):
        if i % by == 0:
            asked.setdefault(i, v)
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in own if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def found(df, by=100, k=10):
    return sorted(map(tuple, topk.top_k(df, lambda i: F.pmod(i, F.lit(by)) == 0, k).collect()))


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op9_exact_top_k"](spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows)


def made(n=300, dim=5, seed=1, spread=1.0):
    rng = random.Random(seed)
    return [(i, [float(rng.randrange(-8, 9)) / 16 * spread for _ in range(dim)], "x") for i in range(n)]


@pytest.mark.parametrize("bins, kept, block", [(512, 4, 4096), (2, 1, 3), (3, 2, 1)])
def test_ties_hot_vector_and_odd_vectors(spark, monkeypatch, bins, kept, block):
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "KEPT", kept)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block)
    rows = made() + [(1000 + k, [0.5, 0.5, 0.5, 0.5, 0.5], "x") for k in range(150)]
    rows += [(None, [1.0] * 5, "x"), (2000, None, "x"), (2100, [1.0, None, 0.0, 0.0, 0.0], "x"), (2200, [math.nan] * 5, "x"), (2300, [math.inf] * 5, "x"),
             (2400, [0.25, 0.5], "x"), (2401, [0.5, 0.5], "x"), (2500, [], "x"), (2501, [], "x"), (-100, [0.1] * 5, "x"), (100, made()[100][1], "x"), (7, [0.5] * 5, "x"), (7, [0.5] * 5, "x")]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5), 50, 7) == brute(rows, 50, 7)


def test_large_components_are_exact(spark):
    rows = made(60, 4, 2, 2.0**17)
    assert found(spark.createDataFrame(rows, SCHEMA), 10, 5) == brute(rows, 10, 5)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = made(n)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)

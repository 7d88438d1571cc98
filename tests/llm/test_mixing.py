"""Source mixing: targets against a plain loop, copies near them, reruns alike."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile("[^\x20\x09-\x0D]+")


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Sharing and resharing, spelled out."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total >= most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: float(most * sizes[s]) for s in over}
        left -= sum(out[s] for s in over)
        free -= over
    return out


def checked(rows, mixed):
    """``rows`` (id, text, source) and the mix of them: everything that holds of any draw."""
    size = {}
    for i, text, source in rows:
        size[source] = size.get(source, 0) + len(WORD.findall(text or ""))
    want, got = targets(size), defaultdict(int)
    assert Counter((r.doc_id, r.source, r["size"]) for r in mixed) == Counter((i, s, len(WORD.findall(t or ""))) for i, t, s in rows)
    for r in mixed:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source])
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 2 * r["size"]
        share = r.target / r.source_size if r.source_size else 0
        assert not r["size"] or int(share) - 1e-9 <= r.copies <= share + 1  # rounded down or up
        got[r.source] += r.taken
    return {s: got[s] - want[s] for s in want}


def mix_of(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("x"), "p": F.lit(1), "target": F.lit(2)})
    return mixing.mix_sources(df.repartition(5), **more)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    out = QUERIES["op12_source_mixing"](spark, SF)
    assert out.columns == ["doc_id", "size", "source_size", "target", "taken"]
    source = {i: s for i, _, s in rows}
    taken, target, largest = Counter(), {}, Counter()
    for r in out.collect():
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r["size"])
    assert all(abs(taken[s] - target[s]) < 0.02 * target[s] for s in target)
    again = QUERIES["op12_source_mixing"](spark, SF)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def made(n, seed=3):
    rng = random.Random(seed)
    sources = ["b", "a", None, "Z", "é", "a2"]
    return [(i, " ".join("w" for _ in range(rng.choice([1, 3, 40, 400]))), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("group", [4, 32, 1024])
def test_levels_of_the_tree_come_near(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP_DOCUMENTS", group)
    rows = made(900)
    missed = checked(rows, mix_of(spark, rows).collect())
    assert all(abs(x) <= 400 for x in missed.values())
    if group == 1024:
        assert all(abs(x) <= 3 for x in missed.values())


def test_partitions_do_not_matter(spark):
    df = spark.createDataFrame(made(300), "doc_id long, text string, source string")
    one, other = (sorted(map(tuple, mixing.mix_sources(df.repartition(n, *by)).collect()), key=repr) for n, by in ((1, ()), (7, ("source",))))
    assert one == other


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_AT_A_TIME", 16)
    rows = [(1, "one copy of many words", "hot")] * 150 + made(40) + [(None, "no id", "b"), (None, None, None), (7, "", "nothing"), (8, None, "nothing"),
            (9, "a b \x0b c", "a"), (3, "the same id", "b"), (3, "another text", "b"), (3, "the same id", "a")]
    missed = checked(rows, mix_of(spark, rows).collect())
    assert all(abs(x) <= 400 for x in missed.values())


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "two words", "s")], [(1, "", "s"), (2, None, "t")]])
def test_few_rows(spark, rows):
    checked(rows, mix_of(spark, rows).collect())


def test_mixed_documents(spark):
    rows = made(60) + [(5, "twice the same", "b")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("clash"))
    mix = mixing.mix_sources(df)
    want = Counter()
    for r in mix.collect():
        want[(r.doc_id, r.source, r["size"])] += r.copies
    out = mixing.mixed_documents(df, mix)
    assert out.columns == df.columns
    assert Counter((r.doc_id, r.source, len(WORD.findall(r.text))) for r in out.collect()) == +want


def test_bounds_are_found_step_by_step(spark):
    sizes = {f"s{k}": 3**k for k in range(8)} | {"zero": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df, (1, 1, 100)).collect()}
    assert got == pytest.approx(targets(sizes, (1, 1, 100)))
    with pytest.raises(ValueError):
        mixing.source_targets(df, share=2.5)


def test_rounding_keeps_words_and_chances():
    rng = np.random.default_rng(1)
    sizes = np.sort(rng.integers(1, 500, 60))[::-1]
    chance, total = 0.37, np.zeros(60)
    for _ in range(3000):
        p = mixing.settle(sizes, np.full(60, chance), rng)
        open_ = (p > 0) & (p < 1)
        assert open_.sum() <= 1 and abs((p * sizes).sum() - chance * sizes.sum()) < 1e-6 * sizes.sum()
        total += p
    assert np.abs(total / 3000 - chance).max() < 0.05  # no document's chance is shifted

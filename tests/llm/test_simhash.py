"""SimHash classes against brute force."""

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import connected_components
from tidemark.llm.queries import QUERIES

from .conftest import SF


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(pairs):
    fps = [brute_fingerprint(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(pairs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        r = find(i)
        known = [x for x in (least.get(r), doc) if x is not None]
        least[r] = min(known) if known else None
    return sorted(((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(pairs)), key=repr)


def classes(df):
    rows = simhash.simhash_classes(df).select("doc_id", "fingerprint", "component_id").collect()
    return sorted(map(tuple, rows), key=repr)


def varied(n, seed=1):
    rng = random.Random(seed)
    base = [rng.choice("alpha beta gamma delta eps zeta eta theta".split()) + str(rng.randrange(50)) for _ in range(300)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        out.append((i, " ".join(words)))
    return out


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_classes([(r.doc_id, r.text) for r in docs.collect()])
    got = QUERIES["op10_simhash_near_dedup"](spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_nulls_empty_repeated_and_long(documents):
    pairs = [(5, None), (3, ""), (4, " \t\n"), (None, "one two"), (9, "one two"), (9, "one two"), (7, "One TWO"),
             (None, "a b c d e f"), (11, "word " * 30000), (10, "word " * 29000), (12, "Ä ä x y"), (13, "ä ä x y")]
    assert classes(documents(pairs)) == brute_classes(pairs)


def test_empty_table(documents):
    assert classes(documents([])) == []
    assert simhash.one_of_each_class(documents([])).count() == 0


def test_slices_do_not_change_fingerprints(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1000}" for i in range(4000)) + " " + "x" * 500
    want = brute_fingerprint(text)
    for size in (7, 64, 1000):
        monkeypatch.setattr(simhash, "SLICE", size)
        assert simhash.text_fingerprint(text) == want


def test_dense_group_is_cut_into_blocks_and_whole(documents, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    pairs = varied(160)
    assert classes(documents(pairs)) == brute_classes(pairs)


@pytest.mark.parametrize("rows", [10, 10**5, 10**8, 10**10])
def test_every_near_pair_shares_a_key(rows):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 2**64, 40, dtype=np.uint64)
    parts = simhash.plan_parts(fps, rows)
    assert sum(p.threshold + 1 for p in parts) == 5
    near = fps.copy()
    for i in range(len(near)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(bit)

    def keys(x):
        out = [set() for _ in x]
        for part, key, at in simhash._keys(x, parts):
            for k, r in zip(key.tolist(), at.tolist()):
                out[r].add((part, k))
        return out
    assert all(a & b for a, b in zip(keys(fps), keys(near)))


def test_one_row_of_each_class_stays(documents):
    pairs = varied(60) + [(1, "same here now please"), (1, "same here now please"), (None, "same here now please"), (70, None), (71, "")]
    df = documents(pairs)
    kept = simhash.one_of_each_class(df)
    assert kept.columns == df.columns
    want = {(c, f) for _, f, c in brute_classes(pairs)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c, _ in want})


def test_components_of_a_path_a_hub_and_a_pair(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(-5, 900), (900, -5), (8, 8)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{k: 1 for k in range(1, 40)}, -5: -5, 900: -5}

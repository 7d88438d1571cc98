"""Leaks against brute force, the bounds of retrieval, and edge cases."""

import math
import pickle
import random
from collections import Counter

import numpy as np
import pandas as pd

from tidemark.llm import decontam as dc
from tidemark.llm.queries import QUERIES

from .conftest import SF


def words(text):
    return dc.WORD.findall((text or "").lower())


def brute_scores(items):
    """Item → {word: weight} divided by the mass a passage must hold."""
    own = {i: words(t) for i, t in items}
    df = Counter(w for ws in own.values() for w in set(ws))
    mean = sum(map(len, own.values())) / len(own)
    out = {}
    for i, ws in own.items():
        weight = {w: math.log(1 + (len(own) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(ws) / mean))
                  for w, n in Counter(ws).items()}
        mass = sum(weight.values()) * min(1.0, 48 / len(ws))
        out[i] = {w: x / mass for w, x in weight.items()}
    return out


def brute_leaks(docs, items):
    items = [(i, t) for i, t in items if words(t)]
    scores = brute_scores(items) if items else {}
    out = set()
    for doc, text in docs:
        ws = words(text)
        passages = [set(ws[s:s + 64]) for s in range(0, max(1, len(ws) - 63 + 31), 32)] if ws else []
        for i, t in items:
            best = max((sum(x for w, x in scores[i].items() if w in p) for p in passages), default=0)
            if best < dc.THRESHOLD:
                continue
            shares = []
            for part in dc.question_and_answer(t):
                want = dc.shingles(part)
                size = len(next(iter(want), ()))
                here = {tuple(ws[k:k + size]) for k in range(len(ws) - size + 1)}
                shares.append(len(want & here) / len(want) if want else 1.0)
            if min(shares) >= dc.MIN_OVERLAP:
                out.add((doc, i))
    return out


def leaks(df, items):
    return sorted(((r.doc_id, r.item_id) for r in dc.find_leaks(df, items).collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = [(r.doc_id, r.item_id) for r in QUERIES["op8_decontamination"](spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_leaks(docs, items)
    verbatim = {(d, i) for d, t in docs for i, q in items if " ".join(words(q)) in " ".join(words(t))}
    assert verbatim <= set(got)


def made(spark, shard_items=None):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(400)]
    common = vocabulary[:30]
    sentence = lambda n: " ".join(rng.choices(common if rng.random() < 0.4 else vocabulary, k=n)).capitalize() + "."
    items = [(i, " ".join(sentence(rng.randrange(3, 14)) for _ in range(rng.randrange(1, 6)))) for i in range(40)]
    items += [(100, "one."), (101, None), (102, "?!"), (103, " ".join(vocabulary[k] for k in range(0, 400, 2)) + ". " + "the last answer is here.")]
    docs = []
    for d in range(60):
        text = [sentence(rng.randrange(5, 25)) for _ in range(rng.randrange(0, 12))]
        if d % 3 == 0:
            text.insert(rng.randrange(len(text) + 1), rng.choice(items[:40])[1].upper().replace(" ", "!! "))
        if d % 5 == 0:
            question = rng.choice(items[:40])[1]
            text.insert(0, question[:len(question) // 2])
        docs.append((d, "\n".join(text)))
    docs += [(70, None), (71, ""), (None, items[3][1]), (None, items[3][1]), (72, "filler " * 70000 + items[5][1] + " filler" * 10), (73, items[43][1])]
    return docs, items


def test_made_cases_against_brute_force(spark, documents):
    docs, items = made(spark)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = leaks(documents(docs).drop("score"), table)
    want = sorted(brute_leaks(docs[:60] + docs[62:63] + docs[-1:] + [(70, None), (71, "")], items) | {(72, 5)}, key=str)
    assert sorted({g for g in got}, key=str) == want
    assert got.count((None, 3)) == 2
    kept = dc.without_leaks(documents(docs), table)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d is not None and not any(d == x for x, _ in want))


def test_shards_blocks_and_slices_do_not_change_results(spark, documents, monkeypatch):
    docs, items = made(spark)
    table = spark.createDataFrame(items, "item_id long, text string")
    want = leaks(documents(docs[:60]), table)
    monkeypatch.setattr(dc, "SHARD_ITEMS", 7)
    monkeypatch.setattr(dc, "BLOCK", 2)
    indexes = dc.build_indexes(table)
    assert len(indexes) > 5 and max(len(x.items) for x in indexes) <= 7
    got = [(docs[row][0], item) for x in indexes for row, item, *_ in x.leaks(pd.Series([t for _, t in docs[:60]]))]
    assert sorted(got, key=str) == want
    one = indexes[0]
    ids = one.ids(docs[3][1])
    monkeypatch.setattr(dc, "SLICE", 11)
    assert np.array_equal(one.ids(docs[3][1]), ids)


def test_repeated_and_null_item_ids(spark, documents, monkeypatch):
    one = "Which river runs through the old town of Arlen? The broad river Sill runs through it."
    two = "How many moons circle the planet Veda at night? Exactly fourteen small moons circle planet Veda."
    three = "Who painted the yellow barn near Lake Orne? Old Matthis Brandt painted that yellow barn."
    items = spark.createDataFrame([(1, one), (1, two), (1, two), (2, three), (None, three), (None, one), (3, "Nothing of this is anywhere. Not at all, no.")],
                                  "item_id long, text string")
    rows = [(1, f"intro words. {one}"), (2, f"{two} And so on."), (3, f"{one} {two}"), (4, three), (5, "no leak here"), (None, one), (None, one)]
    want = sorted([(1, 1), (1, None), (2, 1), (3, 1), (3, None), (4, 2), (4, None)] + 2 * [(None, 1), (None, None)], key=str)
    assert leaks(documents(rows), items) == want
    assert [r.doc_id for r in dc.without_leaks(documents(rows), items).collect()] == [5]
    monkeypatch.setattr(dc, "SHARD_ITEMS", 2)
    assert len(dc.build_indexes(items)) == 3 and leaks(documents(rows), items) == want
    null_only = items.where("item_id is null")
    assert leaks(documents(rows[:1]), null_only) == [(1, None)]


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, "a b c")])
    assert leaks(docs, items) == [] and dc.without_leaks(docs, items).count() == 1
    some = spark.createDataFrame([(1, "What is it? It is a thing.")], "item_id long, text string")
    assert leaks(documents([]), some) == []


def test_blocks_and_postings_are_skipped(spark):
    sf = "/root/testdata/sf0.01"
    index = dc.build_indexes(spark.read.parquet(f"{sf}/benchmark.parquet"))[0]
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert list(index.leaks(pd.Series(texts)))
    work = index.work
    assert 0 < work["pivots"] and work["postings skipped"] > 0
    assert 0 < work["live blocks"] < work["block bounds"] / 10


def test_a_whole_shard_of_items_stays_small():
    """An index of SHARD_ITEMS items with 100,000 different words, and a batch of texts on it."""
    rng = np.random.default_rng(4)
    parts = [np.unique(np.minimum(rng.zipf(1.3, 36), 100_000)) for _ in range(dc.SHARD_ITEMS)]
    names = [[f"w{t}" for t in p] for p in parts]
    rows = pd.DataFrame({"item_id": range(len(parts)), "question": [n[:-5] for n in names], "answer": [n[-5:] for n in names],
                         "terms": [sorted(n) for n in names], "weights": [rng.uniform(0.5, 8, len(n)) for n in names]})
    index = dc._index(rows, dc.BLOCK)
    assert len(pickle.dumps(index)) < 100_000_000
    picked = rng.choice(len(parts), 20, replace=False)
    found = {(r, i) for r, i, *_ in index.leaks(pd.Series([" ".join(rows.question[k] + rows.answer[k]) for k in picked]))}
    assert {(r, int(k)) for r, k in enumerate(picked)} <= found

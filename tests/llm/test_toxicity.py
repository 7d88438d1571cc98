"""The grammar, the learned scores, and held-out accuracy."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity as tx
from tidemark.llm.queries import QUERIES


def gathered(text, model=None):
    values = (model or tx.ToxicityModel()).gathered(text, {})
    return {name: v for name, v in zip(tx.PATTERNS, values) if v}


@pytest.mark.parametrize("text, pattern", [
    ("what an idiot", "insult"), ("you are an idiot", "insult_targeted"), ("he is not an idiot", "insult_negated"),
    ("she said what an idiot", "insult_reported"), ("we kill processes", "threat"), ("you. kill", "threat"),
    ("they will hurt", "threat_targeted"), ("we never kill", "threat_softened")])
def test_patterns(text, pattern):
    assert pattern in gathered(text)


def test_marks_end_with_the_clause():
    assert gathered("I do not agree. what an idiot") == {"insult": 3.0}
    assert gathered("idiot you") == {"insult": 3.0, "late_target": 1.0}


def test_composed_automaton_equals_its_parts():
    rng = random.Random(5)
    steps = [tx.negation_step, tx.reported_step, tx.target_step]
    for _ in range(200):
        state, own = 0, [0, 0, 0]
        for _ in range(30):
            symbol = out = rng.randrange(7)
            for k, step in enumerate(steps):
                own[k], out = step(own[k], out)
            state, got = tx.GRAMMAR[state, symbol]
            assert got == out


def tables(spark, documents, n=400):
    rng = random.Random(2)
    words = [f"w{rng.randrange(300)}" for _ in range(5000)]
    pairs, labels = [], []
    for i in range(n):
        text = rng.sample(words, 40)
        bad = i % 5 == 0
        if bad:
            text[7:7] = [rng.choice(["zorgol", "vexmut", "grimblat"]), "you", rng.choice(["zorgol", "vexmut"])]
        pairs.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    return documents(pairs), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy_and_labels_unseen(spark, documents):
    docs, labels, truth = tables(spark, documents)
    model = tx.learn_toxicity(docs, labels)
    assert {"zorgol", "vexmut", "grimblat"} <= {w for w in ("zorgol", "vexmut", "grimblat", "w1") if model.word(w)[0] == tx.INSULT}
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    got = {r.doc_id: r.predicted for r in tx.score_documents(docs, model).collect()}
    assert all(got[i] == truth[i] for i in truth if held(i))
    flipped = labels.selectExpr("doc_id", "if(pmod(crc32(cast(doc_id as string)), 4) = 2, 1 - toxic, toxic) as toxic")
    assert tx.learn_toxicity(docs, flipped) == model


def test_nulls_empty_repeated_long_and_no_labels(spark, documents):
    docs = documents([(1, None), (2, ""), (3, "!!"), (None, "you idiot"), (4, "x " * 60000 + "you idiot"), (4, "fine"), (4, "fine")])
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (77, 0)], "doc_id long, toxic int")
    for model in (tx.ToxicityModel(), tx.learn_toxicity(docs, labels), tx.learn_toxicity(docs, labels.limit(0))):
        rows = tx.score_documents(docs, model).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
        clean = {r.score for r in rows if r.doc_id in (1, 2)}
        assert len(clean) == 1 and clean.pop() < tx.THRESHOLD
        assert next(r for r in rows if r.doc_id is None).predicted == 1
    assert tx.score_documents(docs.limit(0), tx.ToxicityModel()).count() == 0
    kept = tx.without_toxic(docs, tx.ToxicityModel())
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect())[:3] == [1, 2, 3]


def test_query_scores_every_document(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_toxicity"](spark, sf)
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    held = [r for r in labels if rows[r.doc_id].held_out]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in rows)
    assert sum(rows[r.doc_id].predicted == r.toxic for r in held) / len(held) > 0.9


def test_repeated_ids_are_learned_from_once(spark):
    """A hot id neither shifts the model nor widens the sample: its rows count as one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    hot = docs.where("doc_id % 7 = 0").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(12)))).drop("n")
    once, often = tx.learn_toxicity(docs, labels), tx.learn_toxicity(docs.unionByName(hot), labels)
    assert once.lexicon == often.lexicon and once.lexicon
    assert often.weights == pytest.approx(once.weights) and often.bias == pytest.approx(once.bias)

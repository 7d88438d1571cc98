"""Kneser-Ney probabilities against a direct computation, held-out accuracy, and edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import langid
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string"
WORDS = {"aa": "the of and with thing house green water".split(), "bb": "der die und mit haus grün wasser straße".split()}


def corpus(n=120, seed=3):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(3, 30))).capitalize() + ".", lang, "s")
            for i in range(n) for lang in [("aa", "bb")[i % 2]]]


def direct(texts):
    """log2 P(last | context) by the textbook's recursion over dictionaries."""
    counts = {k: Counter() for k in range(1, langid.ORDER + 1)}
    for t in texts:
        t = "  " + langid.letters(t)
        for k in range(langid.ORDER - 1, len(t)):
            counts[langid.ORDER][t[k - langid.ORDER + 1:k + 1]] += 1
    for order in range(langid.ORDER - 1, 0, -1):
        for g in counts[order + 1]:
            counts[order][g[1:]] += 1
    contexts = {k: defaultdict(list) for k in range(2, langid.ORDER + 1)}
    for k in contexts:
        for g, n in counts[k].items():
            contexts[k][g[:-1]].append(n)
    alphabet = {c for g in counts[langid.ORDER] for c in g} - {" "}

    def p(g):
        d = langid.DISCOUNT
        if len(g) == 1:
            total = sum(counts[1].values())
            return max(counts[1][g] - d, 0) / total + d * len(counts[1]) / total / (len(alphabet) + langid.UNKNOWN)
        ctx = contexts[len(g)].get(g[:-1])
        if not ctx:
            return p(g[1:])
        return max(counts[len(g)][g] - d, 0) / sum(ctx) + d * len(ctx) / sum(ctx) * p(g[1:])
    return p


def test_probabilities_and_entropy_against_the_textbook(spark):
    rows = corpus()
    models = langid.learn_languages(spark.createDataFrame(rows, SCHEMA).repartition(4))
    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    for k, name in enumerate(models.names):
        p = direct([t for _, t, lang, _ in train if lang == name])
        for text in ("The water", "grün", "q", "mit the HAUS 12 und?", "straße " * 40):
            t = "  " + langid.letters(text)
            want = -np.mean([np.log2(p(t[i - 3:i + 1])) for i in range(3, len(t))])
            # a character of the other language only has another share of the unseen
            if all(c in "".join(WORDS[name]) + " q" for c in langid.letters(text)):
                assert models.entropies([text])[0, k] == pytest.approx(want, rel=0.05)


def test_pieces_do_not_change_entropies(spark, monkeypatch):
    models = langid.learn_languages(spark.createDataFrame(corpus(), SCHEMA))
    texts = ["The water and the house", "x", None, "", "mit und " * 50, "12 !", "Der Haus the"]
    want = models.entropies(texts)
    for size in (8, 30, 100):
        monkeypatch.setattr(langid, "CHARS_AT_A_TIME", size)
        np.testing.assert_allclose(models.entropies(texts), want)


def test_edge_cases(spark):
    rows = corpus() + [(500, None, "aa", "s"), (501, "", "bb", "s"), (502, "12 34 ! ² ½ Ⅷ", "aa", "s"), (None, "und der die", None, "s"), (503, "mit haus " * 30000, None, "s"),
                       (7, "repeated und mit", "bb", "s"), (7, "repeated und mit", "bb", "s")]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], SCHEMA + ", score double").repartition(3)
    out = langid.identify(df, langid.learn_languages(df)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].entropy is None for i in (500, 501, 502))
    assert by[None].lang_pred == by[503].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in out)
    unlabelled = df.where("lang is null")
    assert langid.learn_languages(unlabelled) is None
    assert {r.lang_pred for r in langid.identify(unlabelled, None).collect()} == {"und"}
    assert langid.identify(df.limit(0), None).count() == 0


def test_unlike_texts_are_rejected(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    models = langid.learn_languages(df)
    odd = spark.createDataFrame([(1, "zqxj vkzq wqxz jjqk", None, "s"), (2, "the water and the house", None, "s")], SCHEMA)
    assert {r.doc_id: r.rejected for r in langid.identify(odd, models).collect()} == {1: True, 2: False}


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_language_id"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_held_out_rejection_is_near_the_stated_share(spark):
    sf = "/root/testdata/sf0.1"
    rows = QUERIES["op7_language_id"](spark, sf).where("held_out").collect()
    assert 0.0 < sum(r.rejected for r in rows) / len(rows) < 2 * (1 - langid.KEPT_SHARE)


def test_an_id_counts_once(spark):
    """A hot id doesn't outgrow the sample, and gives the same models in any order of rows."""
    rows = corpus()
    hot = [(1, f"und mit der haus {k}", "bb", "s") for k in range(300)] + 300 * [(1, "die", "bb", "s")]
    one = langid.learn_languages(spark.createDataFrame(rows + hot, SCHEMA).repartition(5), sample_rows=20)
    two = langid.learn_languages(spark.createDataFrame((hot + rows)[::-1], SCHEMA).repartition(2), sample_rows=20)
    texts = ["the house and", "die und mit"]
    np.testing.assert_allclose(one.entropies(texts), two.entropies(texts))
    assert [m.rejected_above for m in one.models] == pytest.approx([m.rejected_above for m in two.models])

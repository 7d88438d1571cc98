"""Pieces, ids and packings: whole, gapless, and near the fewest sequences."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import QUERIES

from .conftest import SF

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)


def ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, docs, size=4096):
    """docs: id → text, ids distinct."""
    pieces, sequences = defaultdict(dict), defaultdict(list)
    for r in rows:
        pieces[r.doc_id][r.piece] = r
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        whole = ids(text)
        assert len(pieces[doc]) == -(-len(whole) // size)
        for k, r in pieces[doc].items():
            own = whole[k * size:(k + 1) * size]
            assert (r.start, r.length, r.ids_crc32) == (k * size, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_query_against_the_tokenizer(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op6_best_fit_packing"](spark, SF).collect()
    assert check(rows, docs) <= -(-sum(r.length for r in rows) // 4096) + 1


TEXTS = ["", None, "plain words, here!", "don't we'll I'm 'tis ''s", "Été ÀÉÎ ß ſ İstanbul", "é combining", "日本語 text", "a\x1cb\x85c\xa0d",
         "x²y³ ¼", "<|endoftext|> in a text", "tab\tnew\nline\r\n  spaces", "#hash_tag 3.14 1,000", "\U0001f600 smile", "ŉ ŀ Ŀ", "word" * 4000, "ª º µ"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_the_tokenizer(text, monkeypatch):
    assert [*packing.token_ids([text], PATH)[0].tolist(), 1] == ids(text)
    monkeypatch.setattr(packing, "SLICE", 3)
    assert [*packing.token_ids([text], PATH)[0].tolist(), 1] == ids(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcDEF 's't.,!_-0129éÉß\n\t'\"&"), max_size=60))
def test_ids_equal_the_tokenizer_on_any_plain_text(text):
    assert [*packing.token_ids([text], PATH)[0].tolist(), 1] == ids(text)


def test_memory_is_bounded(monkeypatch):
    met = len(packing._loaded(PATH)[3])
    monkeypatch.setattr(packing, "REMEMBERED", met + 10)
    for k in range(20):
        packing.token_ids([" ".join(f"word{k}x{j}" for j in range(8))], PATH)
    assert len(packing._loaded(PATH)[3]) <= met + 60


def test_batches_equal_single_texts(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_AT_A_TIME", 5)
    assert [x.tolist() for x in packing.token_ids(TEXTS * 3, PATH)] == [ids(t)[:-1] for t in TEXTS * 3]


def test_nulls_empty_long_and_extra_columns(documents):
    texts = {1: None, 2: "", 3: "word " * 9000, 4: "a b c", 5: "z " * 4095, 6: "z " * 4096}
    rows = packing.pack_documents(documents(list(texts.items())), PATH).collect()
    check(rows, texts)


def test_repeated_rows_and_null_ids_are_all_packed(documents):
    rows = packing.pack_documents(documents([(None, "a b"), (None, "a b"), (7, "x"), (7, "x"), (7, "x")]), PATH).collect()
    assert sorted((r.doc_id is None, r.length) for r in rows) == [(False, 2)] * 3 + [(True, 3)] * 2
    assert len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows)[0] == 0
    assert packing.pack_documents(documents([]), PATH).count() == 0


def test_several_groups_and_rounds_lose_little(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 40)
    rng = random.Random(8)
    lengths = [rng.randrange(1, 4097) for _ in range(700)] + [4096] * 5 + [1] * 60
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long").repartition(4)
    rows = packing.pack_pieces(df).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    fills, ends = defaultdict(int), defaultdict(set)
    for r in rows:
        fills[r.sequence_id] += r.length
        ends[r.sequence_id].add((r.offset, r.offset + r.length))
    assert max(fills.values()) <= 4096
    assert all(max(b for _, b in e) == fills[s] and len({a for a, _ in e}) == len(e) for s, e in ends.items())
    alone = len(packing.local_search(packing.best_fit(np.array(lengths), 4096), 4096))
    assert len(fills) <= alone * 1.06 + 2


def test_local_search_finds_what_best_fit_misses():
    # Best fit puts 6 with 3 and 5 with 4, which leaves 2 + 2 + ... in a third bin.
    lengths = np.array([44, 43, 24, 23, 22, 21, 12, 11])
    plain = len(packing.best_fit(lengths, 100))
    which, offset, _ = packing.pack_lengths(lengths, 100)
    assert len(set(which)) <= plain and len(set(which)) == 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60))
def test_packing_of_any_lengths(lengths):
    which, offset, free = packing.pack_lengths(np.array(lengths), 100)
    by_bin = defaultdict(list)
    for w, o, n, f in zip(which, offset, lengths, free):
        by_bin[w].append((o, n, f))
    for own in by_bin.values():
        at = 0
        for o, n, f in sorted(own):
            assert o == at
            at += n
        assert at <= 100 and all(f == 100 - at for *_, f in own)
    assert len(by_bin) <= len(packing.best_fit(np.array(lengths), 100))

"""Fill-in-the-middle against a plain-Python version, with many small frames."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import fim
from tidemark.llm.queries import QUERIES

from .conftest import SF


def plain(doc_id, text, seed=1):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(output), sha(text)


def found(df, frame=fim.FRAME_BYTES):
    return sorted(map(tuple, fim.digests(fim.fill_in_middle(fim.frame_texts(df, frame_bytes=frame))).collect()), key=repr)


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op11_fill_in_middle"](spark, SF).collect()))
    assert got == sorted(plain(*r) for r in rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("frame", [1, 3, 7, 1 << 16])
def test_odd_texts(documents, frame):
    texts = [None, "", "a", "ab", "é", "a😀b", "   ", "\n\n", "x" * 50, "word word, Wörter\r\n" * 3, "<P>", "say <M> here", "<", "<S", "<<P", "P>", "<S<S<",
             "a<M", ">", "日本語のテキスト", "a1b2c3", "\x00\x01"]
    pairs = [(i * 7, t) for i, t in enumerate(texts * 4)] + [(5, "same row"), (5, "same row"), (None, "no id"), (-1, "below zero")]
    assert found(documents(pairs), frame) == sorted((plain(*p) for p in pairs), key=repr)


def test_long_word_spans_frames(documents):
    pairs = [(i, "A" * 200_000 + " end " + "é" * 100_000) for i in range(8)] + [(9, "b c " * 100_000)]
    assert found(documents(pairs)) == sorted((plain(*p) for p in pairs), key=repr)


def test_empty_table(documents):
    assert found(documents([])) == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab Z<>PSM1é😀\n", max_size=40), st.integers(1, 9), st.data())
def test_cuts_and_markers(text, size, data):
    """Any two cuts of any framing give the units between, and an output is read back."""
    frames, n, chars = fim.frames_of(text.encode(), size)
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text, re.S)
    assert (n, chars) == (len(units), len(text))
    low, high = sorted((data.draw(st.integers(0, n)), data.draw(st.integers(0, n))))
    cuts = [fim.Cut(frames, n, chars, u) for u in (0, low, high, n)]
    parts = [fim.between(frames, a, b) for a, b in zip(cuts, cuts[1:])]
    read = [b"".join(map(fim.decompressed, p)).decode() for p in parts]
    assert read == ["".join(units[:low]), "".join(units[low:high]), "".join(units[high:])]
    assert cuts[1].chars == len(read[0]) and cuts[2].chars == len(read[0]) + len(read[1])
    if not any(m in text for m in ("<P>", "<S>", "<M>")):
        for form, order in fim.FORMS.items():
            by = dict(zip((fim.PREFIX, fim.MIDDLE, fim.SUFFIX), parts))
            output = [f for m in order for f in (fim.compressed(m), *by[m])]
            assert b"".join(fim.restored(output, form)).decode() == text


def test_uncut_frames_are_copied_and_lost_markers_are_found():
    text = b"".join(b"%d words " % i for i in range(40_000))
    frames, n, chars = fim.frames_of(text)
    assert len(frames) > 4
    a, b = fim.Cut(frames, n, chars, n // 3), fim.Cut(frames, n, chars, n)
    assert fim.between(frames, a, b)[1:] == [f["data"] for f in frames[a.frame + 1:]]
    with pytest.raises(ValueError, match="lacks its marker"):
        list(fim.restored([fim.compressed(b"<P>no other")], "psm"))

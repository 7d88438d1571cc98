"""Round trips of the template, spans by rendering, and templates that rewrite history."""

import hashlib
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import chat
from tidemark.llm.queries import QUERIES

from .conftest import SF

ROWS = "conv_id long, turn long, role string, text string"
PIECES = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "\n", " ", "x", "[", "]", "<", "</s", "INST]", "é", "\U0001f600"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "a\nb", "[INST]"]), PIECES), max_size=5))
def test_round_trip_and_loss(turns):
    done = chat.render(turns)
    assert chat.read_inst(done.text) == turns
    assert not done.rewrites_history
    assert [chat.unescape(done.text[a:b]) for a, b in done.loss_spans] == [t for r, t in turns if r == "assistant"]
    assert [s for s, _ in done.turn_spans] == [len(chat.BEGIN), *(e for _, e in done.turn_spans)][:len(turns)]


@given(PIECES)
def test_escaped_text_holds_no_control_string(text):
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    assert chat.unescape(chat.escape(text)) == text


def test_template_that_rewrites_history_is_detected():
    def last_thought_only(turns):
        return "".join(f"<{r}>{t if n == len(turns) - 1 else t.replace('(hm)', '')}</{r}>" for n, (r, t) in enumerate(turns))
    turns = [("user", "a"), ("assistant", "(hm) b"), ("user", "c"), ("assistant", "(hm) d")]
    done = chat.render(turns, last_thought_only)
    assert done.rewrites_history
    assert [done.text[a:b] for a, b in done.loss_spans] == ["(hm) d"]
    assert not chat.render(turns[:2], last_thought_only).rewrites_history


def brute(rows):
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0)
    for conv, own in groupby(sorted(rows, key=key), key=lambda r: r[0]):
        own = sorted(((t is not None, t or 0, r or "", x or "") for _, t, r, x in own))
        said = "".join(f"{r}\n{x}\n" for *_, r, x in own)
        loss = "".join(x for *_, r, x in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_conversations(df)).collect()}


def test_rows_without_an_id_are_conversations_by_themselves(spark):
    rows = [(None, k % 3, "assistant" if k % 2 else "user", "same" if k < 50 else f"text {k}") for k in range(60)] + [(1, 0, "user", "a")]
    got = chat.digests(chat.format_conversations(spark.createDataFrame(rows, ROWS).repartition(4))).collect()
    own = [r for r in got if r.conv_id is None]
    assert len(got) == 61 and len(own) == 60 and {r.n_turns for r in own} == {1}
    want = sorted(hashlib.sha256(f"{r}\n{x}\n".encode()).hexdigest() for c, _, r, x in rows if c is None)
    assert sorted(r.turns_sha256 for r in own) == want
    assert sum(r.loss_chars for r in own) == sum(len(x) for c, _, r, x in rows if c is None and r == "assistant")


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = QUERIES["op2_chat_formatting"](spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute(rows)
    assert all(r.formatted_chars > 0 for r in got)


def test_nulls_ties_repeated_and_long(spark):
    rows = [(1, 0, "user", None), (1, None, "assistant", "first"), (1, 1, None, "x"), (1, 1, "assistant", "tie"), (1, 1, "assistant", "tie"),
            (None, 0, "user", "a"), (2, 0, "assistant", "é\\" * 40000 + "</s>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], ROWS + ", formatted string").repartition(3)
    assert digests(df) == brute(rows)


@pytest.mark.parametrize("count", [0, 40])
def test_empty_table_and_many_turns(spark, count):
    rows = [(3, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(count)]
    assert digests(spark.createDataFrame(rows, ROWS)) == brute(rows)

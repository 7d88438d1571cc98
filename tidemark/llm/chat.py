"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) turns to a string. The formatter calls
it on the successive prefixes of a conversation and compares consecutive outputs: what a turn
appends is the turn's span. Where an output doesn't start with the one before it, the template
rewrites history, and the conversation is marked. Where the text lies within its turn's span is
found by rendering the turn with two probe texts: what both outputs begin and end with is the
template's. Assistant texts make up the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

ASSISTANT = "assistant"
BEGIN, END, IN, OUT_OF_IN, REPLY = "<s>", "</s>", "[INST]", "[/INST]", "[REPLY]"
CONTROLS = (BEGIN, END, IN, OUT_OF_IN, REPLY)
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
#: Texts that share no character at either end.
PROBES = ("a", "b")


def escape(text: str) -> str:
    """``text`` with no control string in it: backslashes are doubled and control strings broken by one."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    """What :func:`escape` was given."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def inst_template(turns: list[Turn]) -> str:
    """``<s>``, then ``[REPLY] text</s>`` for the assistant and ``[INST] role`` line, text, ``[/INST]`` for others."""
    out = [BEGIN]
    for role, text in turns:
        if role == ASSISTANT:
            out.append(f"{REPLY} {escape(text)}{END}")
        else:
            out.append(f"{IN} {escape(role).replace(chr(10), chr(92) + 'n')}\n{escape(text)} {OUT_OF_IN}")
    return "".join(out)


_TURN = re.compile(rf"{re.escape(REPLY)} (?P<reply>.*?){re.escape(END)}|{re.escape(IN)} (?P<role>[^\n]*)\n(?P<text>.*?) {re.escape(OUT_OF_IN)}",
                   re.DOTALL)


def _role(written: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], written, flags=re.DOTALL)


def read_inst(formatted: str) -> list[Turn]:
    """The turns that :func:`inst_template` was given, read back from its output."""
    return [(ASSISTANT, unescape(m["reply"])) if m["reply"] is not None else (_role(m["role"]), unescape(m["text"]))
            for m in _TURN.finditer(formatted, len(BEGIN))]


@dataclass
class Formatted:
    """A rendered conversation: spans of the turns and of the texts under the loss mask, in code points."""

    text: str
    turn_spans: list[tuple[int, int]]
    loss_spans: list[tuple[int, int]]
    rewrites_history: bool


def _common(a: str, b: str) -> int:
    """Length of the common beginning."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def render(turns: list[Turn], template: Template = inst_template, trained_role: str = ASSISTANT) -> Formatted:
    """Render ``turns`` prefix by prefix.

    With a template that rewrites history, a turn's span is what follows the common beginning of
    two consecutive outputs, and only spans that the final output still holds are masked.
    """
    before, spans, loss, rewrites = template([]), [], [], False
    for n, (role, _) in enumerate(turns, 1):
        now = template(turns[:n])
        start = _common(before, now)
        rewrites |= start < len(before)
        spans.append((start, len(now)))
        if role == trained_role:
            a, b = (template([*turns[:n - 1], (role, p)]) for p in PROBES)
            head = _common(a, b)
            tail = _common(a[head:][::-1], b[head:][::-1])
            loss.append((n, head, len(now) - tail, now[head:len(now) - tail]))
        before = now
    kept = [(a, b) for n, a, b, text in loss if not rewrites or before[a:b] == text]
    return Formatted(before, spans, kept, rewrites)


def conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """``(conv_id, turns)``, one row for each conversation, its turns by number, role and text.

    A conversation is one training example, so its turns belong in one row. Rows without an id
    belong to no other row: each is a conversation by itself.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = rows.select(F.col(id_col).alias("conv_id"), turn.alias("one"))
    whole = own.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))
    return whole.unionByName(own.where(F.col("conv_id").isNull()).select("conv_id", F.array("one").alias("turns")))


def format_conversations(rows: DataFrame, template: Template = inst_template, id_col: str = "conv_id",
                         turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, formatted, turn_spans, loss_spans, rewrites_history)``, a row for each conversation.

    Null texts and roles are empty; turns with equal or null numbers are ordered by role and text
    (null numbers first), and repeated rows are turns of their own. Each row with a null conversation
    id is a conversation by itself. An empty table gives no rows. Other columns are not looked at. A
    conversation of n turns is rendered n times and twice more for each assistant turn.
    """
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at:at + 256]
                done = [render([(t["role"], t["text"]) for t in turns], template) for turns in part["turns"]]
                yield pd.DataFrame({
                    "conv_id": part["conv_id"].astype("Int64").array, "formatted": [d.text for d in done],
                    "turn_spans": [[list(s) for s in d.turn_spans] for d in done],
                    "loss_spans": [[list(s) for s in d.loss_spans] for d in done],
                    "rewrites_history": [d.rewrites_history for d in done]})

    return conversations(rows, id_col, turn_col, role_col, text_col).select(F.col("conv_id").cast("long").alias("conv_id"), "turns") \
        .mapInPandas(work, "conv_id long, formatted string, turn_spans array<array<long>>, "
                           "loss_spans array<array<long>>, rewrites_history boolean")


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the outputs of :func:`inst_template`: turns, their digest, the loss text's size and digest."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for conv, text, spans in zip(pdf["conv_id"].astype("Int64"), pdf["formatted"], pdf["loss_spans"]):
                turns = read_inst(text)
                said = "".join(f"{role}\n{own}\n" for role, own in turns)
                loss = "".join(unescape(text[a:b]) for a, b in spans)
                rows.append((conv, len(turns), _sha256(said), len(loss), _sha256(loss), len(text)))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield out.astype({"conv_id": "Int64"})

    return formatted.select("conv_id", "formatted", "loss_spans").mapInPandas(
        work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()

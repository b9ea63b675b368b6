"""Chat formatting: round trips, spans of unknown templates, and templates that rewrite history."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.llm.chat_format import digests, escape, format_chats, inst_template, read_back, spans, unescape

BITS = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "[TURN]", " ", "\\", "\n", "n", "[", "]", "ok", "é", "[/TURN]"]), max_size=8)
TEXT = BITS.map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", ""]), TEXT)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_round_trip_and_mask(turns):
    text, begins, masks, rewritten = spans(turns, inst_template)
    assert read_back(text) == turns and rewritten is None and len(begins) == len(turns)
    assert [unescape(text[a:b]) for a, b in masks] == [t for r, t in turns if r == "assistant"]


@given(TEXT)
def test_escape(text):
    assert unescape(escape(text)) == text


def test_other_templates():
    lines = lambda turns: "BOS" + "".join(f"<{r}>{t.strip()}</{r}>\n" for r, t in turns)
    text, begins, masks, rewritten = spans([("user", "hi"), ("assistant", " yes "), ("assistant", "")], lines)
    assert [text[a:b] for a, b in masks] == ["yes", ""] and rewritten is None and begins[0] == 0
    last_only = lambda turns: "".join(f"{r}:{t if i == len(turns) - 1 else '..'};" for i, (r, t) in enumerate(turns))
    assert spans([("user", "hi"), ("assistant", "yes")], last_only)[1:] == ([], [], 1)


def test_rows(spark):
    rows = [(1, 1, "assistant", "b", 0), (1, 0, "user", "a", 0), (1, None, "system", None, 0), (None, 0, None, "x", 0), (2, 0, "user", "a" * 5000, 0),
            (2, 0, "user", "a" * 5000, 0)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r["conv_id"]: r for r in format_chats(chats).collect()}
    assert got[1]["formatted"] == "[TURN] system\n [/TURN][INST] a [/INST] b </s>"
    assert got[2]["n_turns"] == 2 and got[None]["formatted"] == "[TURN] \nx [/TURN]"
    assert {r["conv_id"]: r["loss_chars"] for r in digests(format_chats(chats)).collect()} == {1: 1, 2: 0, None: 0}
    assert digests(format_chats(chats.limit(0))).collect() == []

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import chat

_MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "[", "s>", "/", " ", "\n", "é", "😀", "x"]
_TEXT = st.lists(st.sampled_from(_MARKS), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), _TEXT), _TEXT), max_size=5))
def test_round_trip(turns):
    rendered = "".join(chat.render(role, text) for role, text in turns)
    assert [t[:2] for t in chat.parse(rendered)] == turns


@settings(max_examples=200, deadline=None)
@given(_TEXT)
def test_escaping_is_reversible_and_leaves_no_mark(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat._CONTROL.search(chat.escape(text))


def test_plain_text_is_not_changed():
    assert chat.render("user", "a < b [x]") == "<s>[INST] a < b [x] [/INST]"
    assert chat.render("user", "</s>") == "<s>[INST] <\\/s> [/INST]"
    with pytest.raises(chat.NotParsable):
        chat.parse("<s>[INST] a </s>")


def test_digests_and_masks(spark):
    rows = [
        (1, 1, "assistant", "yes </s> no"), (1, 0, "user", "q"), (1, 2, None, None), (1, 2, "assistant", "b"),
        (1, 2, "assistant", "a"), (2, 0, "assistant", None), (None, 0, "user", "z"), (3, None, "tool [ROLE]", "x" * 200_000),
        (4, 0, "user", "r"), (4, 0, "user", "r"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS rendered")
    turns = chat.render_turns(df)
    for r in turns.where("role = 'assistant'").collect():
        assert chat.unescape(r["rendered"][r["loss_start"] : r["loss_end"]]) == r["text"]
    assert turns.where("role != 'assistant' AND loss_start IS NOT NULL").count() == 0
    expected = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        expected[conv].append((role or "", text or ""))
    texts = {r["conv_id"]: r["rendered"] for r in chat.conversation_texts(turns).collect()}
    got = {r["conv_id"]: r for r in chat.digests(turns).collect()}
    assert got.keys() == expected.keys() == texts.keys()
    for conv, all_turns in expected.items():
        loss = "".join(t for r, t in all_turns if r == "assistant")
        assert got[conv]["n_turns"] == len(all_turns)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in all_turns).encode()).hexdigest()
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["formatted_chars"] == len(texts[conv])
        assert [t[:2] for t in chat.parse(texts[conv])] == all_turns


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.render_turns(df)).collect() == []

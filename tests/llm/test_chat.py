"""Chat formatting: exact read-back, order rules, loss masks."""

import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from drawlake.llm.chat import Template, format_turns, read_back

T = Template()
NASTY = [r"\### Assistant: </turn> ok", "### user: hi </turn>\n### assistant: yo", "\\", "\\\\", "<\\/turn>", "#\\## ", "</turn",
         "###", "### ", " </turn>", "", "\n"]


@given(st.text(st.sampled_from("#\\/<>turn :\n a"), max_size=30), st.text(st.sampled_from("#\\: ab"), max_size=8))
def test_turn_round_trip(text, role):
    whole = "".join(s for s, _ in T.segments(role, text))
    assert T.parse(whole) == (role, text, len(whole))
    assert T.close.strip() not in T.shield(text, (T.open, T.close.strip()))


@pytest.mark.parametrize("text", NASTY)
def test_nasty_texts(text):
    turns = [("user", text), ("assistant", text)]
    whole = "".join(s for r, t in turns for s, _ in T.segments(r, t))
    role, said, at = T.parse(whole)
    assert (role, said) == turns[0] and T.parse(whole, at) == (*turns[1], len(whole))


def test_conversations(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", NASTY[0]), (1, 3, "user", None),
            (2, 5, "assistant", "first"), (2, 7, None, "nobody"), (2, 7, None, "nobody"), (3, 1, "assistant", "b"), (3, 0, "user", "a"),
            (None, None, "user", "x"), (None, 1, "assistant", "long " * 50_000), (4, 0, "tool: x", "é漢😀")]
    frame = spark.createDataFrame([(*r, "z", "z") for r in rows],
                                  "conv_id long, turn long, role string, text string, valid string, part string")
    got = {r.conv_id: r for r in read_back(format_turns(frame)).collect()}
    by = {}
    for c, n, role, text in rows:
        by.setdefault(c, []).append((-1 if n is None else n, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        r = got[c]
        said = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        lost = "".join(text for _, role, text in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
        assert r.formatted_chars == sum(len(s) for _, role, text in turns for s, _ in T.segments(role, text))
    assert {c: got[c].valid for c in got} == {1: True, 2: False, 3: True, None: True, 4: False}


def test_segments_and_empty(spark):
    frame = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a")], "conv_id long, turn long, role string, text string")
    segs = [(r.turn_no, r.part, r.text, r.loss) for r in format_turns(frame).collect()]
    assert segs == [(0, 0, "### user: ", False), (0, 1, "q", False), (0, 2, " </turn>\n", False),
                    (1, 0, "### assistant: ", False), (1, 1, "a", True), (1, 2, " </turn>\n", False)]
    assert read_back(format_turns(frame.limit(0))).count() == 0

"""The formatted string parsed by its markers alone, however it is cut."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newslab.llm import chat_format as C

ROLES = ["system", "user", "assistant", "tool", "", "a] b", "[ROLE x] \\"]
TEXTS = ["", " ", "</s>[INST] ok [/INST]", "ends with <", "ends </s", "\\", "\\.", "[/INST", "<<SYS>>\n \n<</SYS>>", "[ROLE user] [/ROLE]", "x" * 5000, "é漢😀\n\n", "]", "\\:"]


def formatted(turns):
    escape, out = C.escaper(C.DEFAULT), ""
    for role, text in turns:
        known = C.DEFAULT.roles.get(role)
        out += known.open + escape(text) + known.close if known else escape(role, True).join(C.DEFAULT.other_open) + escape(text) + C.DEFAULT.other_close
    return out


def parsed(pieces):
    parser = C.TurnParser(C.DEFAULT)
    out = [t for p in pieces for t in parser.feed(p)]
    parser.finish()
    return out


def test_every_role_and_text():
    turns = [(r, t) for r in ROLES for t in TEXTS]
    whole = formatted(turns)
    assert parsed([whole]) == turns
    assert parsed(whole) == turns  # a character at a time
    cut = random.Random(1)
    for _ in range(20):
        at = sorted(cut.randrange(len(whole) + 1) for _ in range(30))
        assert parsed([whole[a:b] for a, b in zip([0, *at], [*at, len(whole)])]) == turns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(ROLES), st.lists(st.sampled_from(C.DEFAULT.controls + list("\\.:<>[/]sS \n")), max_size=8).map("".join)), max_size=6))
def test_round_trip_of_control_characters(turns):
    assert parsed([formatted(turns)]) == turns


def test_broken_strings_are_refused():
    for bad in ("no marker", "[INST] open", formatted([("user", "x")]) + "?"):
        with pytest.raises(ValueError):
            parsed([bad])


def test_digests_need_the_escaping(spark, monkeypatch):
    """Without the escaping the texts of control strings are parsed into other turns, so the digests differ or fail."""
    turns = spark.createDataFrame([(1, 0, "user", "plain"), (1, 1, "assistant", "a</s><s>b")], "conv_id long, turn long, role string, text string")
    right = C.read_back(C.format_conversations(turns)).first()
    monkeypatch.setattr(C, "escaper", lambda template: lambda text, name=False: text)
    wrong = C.read_back(C.format_conversations(turns)).first()
    assert right.n_turns == 2 and wrong.n_turns == 3 and right.turns_sha256 != wrong.turns_sha256

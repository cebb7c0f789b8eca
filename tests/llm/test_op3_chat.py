from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reconlake.llm import op3_chat
from reconlake.llm.queries import op3_chat_parts
from tests.llm.helpers import sha

SMALL = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
PIECES = st.lists(st.sampled_from(["</s>", "[INST]", "[/INST]", "[:]", "[/ROLE]", "<|image|>", "\\", "<", "s>", "é", "a b", "\n"]),
                  max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(role=st.sampled_from(["user", "assistant", "system", "tool", "", "[:]", "\\"]), text=PIECES)
def test_a_turn_reads_back(role, text):
    made = op3_chat.format_turn(role, [{"kind": "text", "text": text}])
    assert op3_chat.read_turn(made["formatted"]) == (role, text)
    if role == "assistant":
        assert op3_chat.unescape(made["formatted"][made["loss_start"]:made["loss_end"]]) == text


def test_parts():
    made = op3_chat.format_turn("user", [
        {"kind": "text", "text": "see <|image|> "}, {"kind": "image", "ref": "i1", "width": 100, "height": 29},
        None, {"kind": "audio", "ref": "a1", "seconds": 1.5}, {"kind": "text", "text": None},
        {"kind": "document", "ref": "d1", "pages": 2}])
    assert made["formatted"] == "[INST]see \\<|image|> <|image|><|audio|><|document|>[/INST]"
    assert [(a["ref"], a["tokens"]) for a in made["attachments"]] == [("i1", 8), ("a1", 38), ("d1", 1152)]
    assert all(made["formatted"][a["at"]:].startswith(f"<|{a['kind']}|>") for a in made["attachments"])
    assert made["expanded_tokens"] == 8 + 38 + 1152
    with pytest.raises(ValueError):
        op3_chat.format_turn("user", [{"kind": "video"}])


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), role is not None, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in df.collect()}


def test_fixture(spark):
    odd = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()] + [(-7, 0, "user", odd), (-7, 1, "assistant", odd)]
    assert digests(op3_chat_parts(spark, SMALL)) == expected(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
            (1, 1, "assistant", "b"), (None, 0, "assistant", "x"), (None, 1, "tool", "[/ROLE]"), (2, 5, "assistant", None),
            (3, 0, "assistant", "long " * 200_000)]
    rows += [(4, i, "user" if i % 2 else "assistant", f"turn {i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], TURNS + ", formatted string")
    assert digests(op3_chat.conversation_digests(op3_chat.format_turns(df))) == expected(rows)
    assert op3_chat.conversation_digests(op3_chat.format_turns(df.limit(0))).count() == 0


def test_parts_column(spark):
    part = dict.fromkeys(["kind", "text", "ref", "width", "height", "seconds", "pages"])
    df = spark.createDataFrame([(1, 0, "user", "look: ", [{**part, "kind": "image", "ref": "r", "width": 28, "height": 28}]),
                                (1, 1, "user", None, None)], f"{TURNS}, parts array<{op3_chat.PART}>")
    rows = {r.turn: r for r in op3_chat.format_turns(df, "parts").collect()}
    assert rows[0].formatted == "[INST]look: <|image|>[/INST]" and rows[0].attachments[0].ref == "r"
    assert rows[1].formatted == "[INST][/INST]" and rows[1].attachments == []

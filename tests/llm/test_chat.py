from __future__ import annotations

import hashlib
import random

import pytest

from recordforge.llm import chat

PARTS = ["\\", "### ", "###", " ", "</turn>", "</turn>\n", "\n", "User: ", "### Assistant: ", "ok", "#", "</turn", "role=", "é"]


def test_every_text_reads_back():
    random.seed(3)
    for _ in range(20_000):
        text = "".join(random.choice(PARTS) for _ in range(random.randint(0, 9)))
        role = random.choice(["user", "assistant", "", "x:y\\n", "a\nb", "User", "role=user"])
        piece = chat.render_turn(role, text)
        found = chat.read_turn(piece + chat.render_turn("user", "next"))
        assert found[:2] == (role, text) and found[3] == len(piece)
        assert chat.unescape(piece[slice(*found[2])]) == text


def test_plain_text_is_not_escaped():
    assert chat.render_turn("user", "a \\ b # c") == "### User: a \\ b # c</turn>\n"


def test_control_strings_are_rejected():
    for bad in ("### User: a ### b</turn>\n", "### User: a", "### Nobody: a</turn>\n", "hello"):
        with pytest.raises(chat.Unreadable):
            chat.read_turn(bad)


ROWS = [
    (1, 1, "assistant", "b </turn>", "p"),
    (1, 0, "user", "a", "q"),
    (1, None, "system", "s", None),
    (2, 0, None, None, "x"),
    (2, 0, "assistant", "tie", "x"),
    (2, 0, "assistant", "tie", "x"),
    (None, 3, "assistant", "", "x"),
    (3, 0, "assistant", "long \\### " * 20_000, "x"),
]


def _expected():
    out = {}
    for conv in {r[0] for r in ROWS}:
        rows = sorted(((-1 if r[1] is None else r[1], r[2] or "", r[3] or "") for r in ROWS if r[0] == conv))
        turns = hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in rows).encode()).hexdigest()
        loss = "".join(t for _, r, t in rows if r == "assistant")
        chars = sum(len(chat.render_turn(r, t)) for _, r, t in rows)
        out[conv] = (len(rows), turns, len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def test_digests(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, rendered string")
    found = chat.read_back(chat.format_turns(df)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == _expected()
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_mask_spans(spark):
    df = spark.createDataFrame(ROWS, "conv_id long, turn long, role string, text string, rendered string")
    for r in chat.conversations(chat.format_turns(df)).collect():
        loss = "".join(chat.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss"])
        assert (len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(r["formatted"])) == _expected()[r["conv_id"]][2:]

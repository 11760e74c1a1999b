"""Formatted conversations read back: texts, roles and loss spans as they went in."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from codeset.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["### ", "</turn>", "\\", "\n", "a", "é", "🙂", ": ", "#", "<", "/turn>", " ", "\\### ", "### x: "]


def random_text(pick, n=12):
    return "".join(pick.choice(PARTS) for _ in range(pick.randrange(n)))


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        key = (turn is not None, turn or 0, role or "", text or "")
        convs.setdefault(conv, []).append(key)
    out = set()
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out.add((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("piece", [4 << 20, 40])
def test_round_trip(spark, monkeypatch, piece):
    """Also where conversations are cut into many pieces."""
    monkeypatch.setattr(chat, "PIECE_BYTES", piece)
    pick = random.Random(piece)
    rows = [
        (conv, turn, pick.choice(["user", "assistant", "a: b\\", "x\ny", "</turn>", ""]), random_text(pick))
        for conv in range(60) for turn in range(pick.randrange(1, 7))
    ]
    pieces = chat.format_conversations(spark.createDataFrame(rows, SCHEMA))
    found = chat.read_back(pieces).collect()
    assert {tuple(r)[:5] for r in found} == brute(rows)
    lengths = {}
    for row in pieces.collect():
        lengths[row["conv_id"]] = lengths.get(row["conv_id"], 0) + len(row["formatted"])
    assert {r["conv_id"]: r["formatted_chars"] for r in found} == lengths


def test_awkward_rows(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", ""), (None, 0, "user", "x"), (None, None, "user", "first"),
            (2, 5, "assistant", "same"), (2, 5, "assistant", "same"), (3, 0, "user", "word " * 50_000)]
    found = chat.read_back(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {tuple(r)[:5] for r in found} == brute(rows)
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.format_conversations(empty)).collect() == []
    more = {name: F.lit("x") for name in ("_turn", "_role", "_text", "_learnt", "piece", "formatted", "loss")}
    clashing = spark.createDataFrame(rows, SCHEMA).withColumns(more)
    assert {tuple(r) for r in chat.read_back(chat.format_conversations(clashing)).collect()} == {tuple(r) for r in found}


def test_format_of_a_turn():
    held = chat.Assembly(pa.array(["assistant", "a:b"]), pa.array(["\\### Assistant: </turn> ok", "é"]))
    whole, second = held.pieces(np.array([0])).to_pylist()[0], held.pieces(np.array([0, 1])).to_pylist()[1]
    assert whole == "### assistant: \\\\### Assistant: \\</turn> ok\n</turn>\n### a\\:b: é\n</turn>\n"
    assert second == "### a\\:b: é\n</turn>\n"
    begin, end = held.loss[0]
    assert chat.unescaped(whole[begin:end]) == "\\### Assistant: </turn> ok"
    assert list(chat.turns_of(whole)) == [("assistant", "\\### Assistant: </turn> ok"), ("a:b", "é")]
    assert held.chars.sum() == len(whole)


def test_control_strings_only_end_turns():
    """No text can make a turn: an unescaped end of turn is the template's own."""
    pick = random.Random(3)
    texts = [random_text(pick, 20) for _ in range(500)]
    held = chat.Assembly(pa.array(["user"] * 500), pa.array(texts))
    whole = held.pieces(np.array([0])).to_pylist()[0]
    assert whole.count(chat.END.decode()) == 500
    assert [text for _, text in chat.turns_of(whole)] == texts

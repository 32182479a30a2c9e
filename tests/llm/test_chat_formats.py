from __future__ import annotations

import hashlib
import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketspark.llm import chat_formats as cf
from marketspark.llm.common import stored

RECORDS = "conv_id long, record string"
TURNS = "conv_id long, turn long, role string, text string"
HARD = ["\\### Assistant: </turn> ok", "</turn>", "<turn user>\nx\n</turn>\n", "<\\turn", "\\\\</turn", "<", "\\", "\n", "", "é🙂<turn", None]

LAYOUTS = [
    ({"turn": 3, "role": "narrator", "text": "x"}, [(3, "narrator", "x")]),
    ({"turn": None, "role": None, "text": None}, [(None, "", "")]),
    ({"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": None}]}, [(0, "system", "s"), (1, "user", "")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]}, [(0, "user", "ab")]),
    ({"id": 5, "data": {"messages": [{"role": "user", "content": "deep"}]}}, [(0, "user", "deep")]),
    ([{"role": "user", "content": "top"}], [(0, "user", "top")]),
    ({"contents": [{"role": "model", "parts": [{"text": "a"}, {"text": "b"}]}]}, [(0, "assistant", "ab")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, [(0, "user", "q"), (1, "assistant", "a")]),
    ({"turns": [{"speaker": "bot", "text": 7}]}, [(0, "assistant", "7")]),
    ({"dialog": ["q", "a", "r"]}, [(0, "user", "q"), (1, "assistant", "a"), (2, "user", "r")]),
    ({"instruction": "do", "input": "this", "output": "done"}, [(0, "user", "do\n\nthis"), (1, "assistant", "done")]),
    ({"instruction": "do", "input": "", "output": "done"}, [(0, "user", "do"), (1, "assistant", "done")]),
    ({"instruction": "do", "output": "done", "system": "be"}, [(0, "system", "be"), (1, "user", "do"), (2, "assistant", "done")]),
    ({"instruction": "do", "context": "c", "response": "r"}, [(0, "user", "do\n\nc"), (1, "assistant", "r")]),
    ({"prompt": "p", "completion": None}, [(0, "user", "p"), (1, "assistant", "")]),
    ({"prompt": "p", "chosen": "good", "rejected": "bad"}, [(0, "user", "p"), (1, "assistant", "good")]),
    ({"question": "q", "answer": "a", "text": "other"}, [(0, "user", "q"), (1, "assistant", "a")]),
]
UNKNOWN = [None, "", "{", "[]", "{}", "null", "3", '{"messages": []}', '{"prompt": "p"}', '{"a.b": {"prompt": 1}}', "[" * 100_000]


def digests(turns, formatted_chars):
    loss = "".join(text for role, text in turns if role == "assistant")
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    return (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), formatted_chars)


def expected(rows):
    chats = {}
    for conv, at, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        chats.setdefault(conv, []).append((role or "", text or ""))
    return {conv: digests(turns, sum(len(cf.written(*turn)[0]) for turn in turns)) for conv, turns in chats.items()}


def found(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r)[1:] for r in rows}


def test_every_layout_gives_its_turns(spark):
    rows = [(k, json.dumps(record)) for k, (record, _) in enumerate(LAYOUTS)] * 2
    turns = cf.canonical_turns(spark.createDataFrame(rows, RECORDS).repartition(3).withColumn("turn", F.lit("x"))).collect()
    expected_rows = [(k, *turn) for k, (_, turns) in enumerate(LAYOUTS) for turn in turns] * 2
    assert sorted(tuple(r)[:4] for r in turns if r.turn is not None) == sorted(r for r in expected_rows if r[1] is not None)
    assert sum(r.turn is None for r in turns) == 2 and all(r.layout and r.fingerprint for r in turns)


def test_one_fingerprint_for_one_set_of_paths(spark):
    one, other = {"prompt": "a", "meta": {"x": 1}, "completion": "b"}, {"completion": "", "meta": {"x": None}, "prompt": "c"}
    rows = [(1, json.dumps(one)), (2, json.dumps(other)), (3, json.dumps(one | {"meta": {"y": 1}}))]
    marks = {r.conv_id: r.fingerprint for r in cf.canonical_turns(spark.createDataFrame(rows, RECORDS)).collect()}
    assert marks[1] == marks[2] != marks[3]


def test_what_no_layout_fits_is_reported(spark):
    rows = [(k, record) for k, record in enumerate(UNKNOWN)] + [(None, '{"dialog": ["q"]}')]
    turns = {r.conv_id: r for r in cf.canonical_turns(spark.createDataFrame(rows, RECORDS)).collect()}
    assert len(turns) == len(rows) and turns[None].text == "q"
    assert all(turns[k][1:5] == (None, None, None, None) for k in range(len(UNKNOWN)))
    assert [k for k in range(len(UNKNOWN)) if turns[k].fingerprint is None] == [0, 1, 2, 10]
    formatted = cf.format_conversations(cf.canonical_turns(spark.createDataFrame(rows, RECORDS)))
    assert found(cf.read_back(formatted)) == expected([(None, 0, "user", "q")])


def test_lone_surrogates_become_a_mark(spark):
    turns = cf.canonical_turns(spark.createDataFrame([(1, '{"dialog": ["a\\ud800b"]}')], RECORDS)).collect()
    assert turns[0].text == "a\ufffdb"


@pytest.mark.parametrize("part", [1 << 20, 40])
def test_conversations_come_back_exactly(spark, monkeypatch, part):
    monkeypatch.setattr(cf, "PART_CHARS", part)
    rng = random.Random(part)
    rows = [(conv, at, rng.choice(["user", "assistant", "system", None, "a>\n b", ""]), rng.choice(HARD) if rng.random() < 0.5 else rng.choice("ab") * 30)
            for conv in [*range(-7, 40), None] for at in range(rng.randint(1, 9))]
    rows += [(3, None, "assistant", "no turn"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same")]
    table = spark.createDataFrame(rows, TURNS).repartition(5).withColumn("part", F.lit("x"))
    formatted = cf.format_conversations(table)
    assert found(cf.read_back(formatted, in_order=True)) == expected(rows)
    kept = stored(formatted, "formatted")
    assert found(cf.read_back(kept.repartition(7))) == expected(rows)
    pieces = kept.collect()
    assert len(pieces) == len({r.conv_id for r in pieces}) if part > 1000 else len(pieces) > 100
    for r in pieces:
        masked = [cf.unescaped(r.formatted[a:b]) for a, b in zip(r.loss_starts, r.loss_ends, strict=True)]
        assert masked == [text for role, text, _, _ in cf.parsed(r.formatted) if role == "assistant"]


def test_a_hot_conversation_and_a_long_text(spark):
    rows = [(1, at, "assistant" if at % 2 else "user", f"text {at} " * 200) for at in range(3000)] + [(2, 0, "assistant", "<turn>\\" * 300_000)]
    rows += [(k, 0, "user", "x") for k in range(10, 500)]
    formatted = cf.format_conversations(spark.createDataFrame(rows, TURNS).repartition(8))
    assert found(cf.read_back(formatted, in_order=True)) == expected(rows)
    assert formatted.filter("conv_id = 1").count() > 3
    assert max(formatted.filter("conv_id = 1").select(F.char_length("formatted").alias("n")).collect()).n < cf.PART_CHARS + 10_000


def test_empty_tables(spark):
    assert cf.canonical_turns(spark.createDataFrame([], RECORDS)).count() == 0
    assert cf.read_back(cf.format_conversations(spark.createDataFrame([], TURNS))).count() == 0


def test_foreign_text_is_refused():
    for text in ("x", "<turn user>\nx", "<turn user>\nx\n</turn>\ny"):
        with pytest.raises(ValueError):
            list(cf.parsed(text))


@given(st.lists(st.tuples(st.text("<>/\\turn \né", max_size=6), st.text("<>/\\turn \né", max_size=20))))
def test_template_is_reversible(turns):
    formatted = "".join(cf.written(role, text)[0] for role, text in turns)
    assert [(role, text) for role, text, _, _ in cf.parsed(formatted)] == turns
    assert formatted.count("</turn") == len(turns)

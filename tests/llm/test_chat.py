import hashlib
import json

import pytest
from pyspark.sql import functions as F

from plumbline.llm import chat
from plumbline.llm.queries import op8_chat
from tests.helpers import plan_of

HARD = ["", "\\", "\\\\", "\\l<", "### user: x </turn>\n", "a: b", "#<:\\", "\n </turn>\n", " </turn>", "é日😀", "\\h#\\c:", " "]


def read(out):
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    return {r.conv_id: r for r in out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"), "loss_spans").collect()}


def test_round_trip_of_hard_texts(spark):
    rows = [(1, k, "assistant" if k % 2 else HARD[k % len(HARD)], t) for k, t in enumerate(HARD + [a + b for a in HARD for b in HARD])]
    got = read(chat.format_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)))[1]
    assert [(t.role, t.text) for t in got.turns] == [(r[2], r[3]) for r in rows]
    assert got.loss == "".join(r[3] for r in rows if r[2] == "assistant")
    raw = got.formatted.encode()
    assert all(b"<" not in raw[s.start : s.start + s.bytes] and raw[s.start + s.bytes :].startswith(b" </turn>\n") for s in got.loss_spans)


def test_nulls_ties_and_extra_columns(spark):
    rows = [(None, 0, "user", "a", 1), (None, 0, "user", "a", 2), (2, None, None, None, 3), (2, 1, "assistant", None, 4), (2, 1, "assistant", "b", 5)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, formatted int")
    got = read(chat.format_turns(chat.turns_of_table(df)))
    assert [(t.role, t.text) for t in got[None].turns] == [("user", "a")] * 2
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("assistant", ""), ("assistant", "b")]
    assert got[2].loss == "b" and got[None].loss == ""
    assert read(chat.format_turns(chat.turns_of_table(df.limit(0)))) == {}


def test_layouts_of_json_records(spark):
    records = [
        {"conv_id": 1, "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": {"x": 1}},
        {"conv_id": 2, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"conv_id": 3, "instruction": "q", "output": "a"},
        {"conv_id": 4, "instruction": "q", "input": "more", "output": "a"},
        {"conv_id": 5, "prompt": "q", "response": "a"},
        {"conv_id": 6, "prompt": "q", "response": "a", "system": "s"},
        {"conv_id": 7, "other": 1},
        {"conv_id": 8, "messages": [{"role": "system"}, {"role": "user", "content": "q"}]},
        {"conv_id": 9, "messages": []},
        {"conv_id": 10, "turn": 1, "role": "assistant", "text": "a"},
        {"conv_id": 10, "turn": 0, "role": "user", "text": "q"},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [("not json",), (None,)], "json string")
    got = {}
    for r in chat.turns_of_json(df).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text) if r.is_turn else r.layout)
    two = [("user", "q"), ("assistant", "a")]
    assert got == {
        1: two, 2: two, 3: two, 4: [("user", "q\n\nmore"), two[1]], 5: two, 6: [("system", "s"), *two], 7: [None], 8: [("system", None), ("user", "q")], 9: [None], 10: two, None: [None, None],
    }
    out = read(chat.format_turns(chat.turns_of_json(df)))
    assert [(t.role, t.text) for t in out[8].turns] == [("system", ""), ("user", "q")] and out[10].loss == "a"
    assert all(out[k].formatted == "" and out[k].turns == [] and out[k].loss_spans == [] for k in (7, 9, None))


def test_records_without_turns_do_not_move_spans(spark):
    df = spark.createDataFrame([('{"conv_id": 1, "x": 1}',), ('{"conv_id": 1, "prompt": "q", "response": "aa"}',), ('{"conv_id": 1, "messages": []}',)], "json string")
    got = read(chat.format_turns(chat.turns_of_json(df)))[1]
    assert got.loss == "aa" and [t.text for t in got.turns] == ["q", "aa"]


def test_layouts_of_tables(spark):
    df = spark.createDataFrame([(1, "q", "a", 9)], "conv_id bigint, prompt string, response string, note int")
    assert [tuple(r)[:5] for r in chat.turns_of_table(df).collect()] == [(1, 0, "user", "q", "prompt"), (1, 1, "assistant", "a", "prompt")]
    nested = spark.createDataFrame([(1, [("user", "q")])], "conv_id bigint, messages array<struct<role:string,content:string>>")
    assert "messages[].role" in chat.schema_paths(nested.schema)
    assert [tuple(r)[:4] for r in chat.turns_of_table(nested).collect()] == [(1, 0, "user", "q")]
    empty = spark.createDataFrame([(1, []), (2, None)], nested.schema)
    assert [tuple(r) for r in chat.turns_of_table(empty).orderBy("conv_id").collect()] == [(k, None, None, None, "messages", False) for k in (1, 2)]
    rows = spark.createDataFrame([(1, 0, "user", "q", 3)], "conv_id bigint, turn int, role string, text string, note int")
    assert chat.fingerprint(["turn", "role", "text"]) == chat.fingerprint(chat.LAYOUTS[-1].paths) and chat.turns_of_table(rows).first().layout == "turn"
    with pytest.raises(ValueError):
        chat.turns_of_table(spark.range(1))


def test_query_is_native_and_has_the_added_conversation(spark, rows):
    got = {r.conv_id: r for r in rows("op8_chat")}
    said = "\\### Assistant: </turn> ok"
    assert got[-7].n_turns == 2 and got[-7].loss_chars == len(said)
    assert got[-7].turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    plan = plan_of(op8_chat(spark, "/root/testdata/sf0.01"))
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "ArrowEval"))

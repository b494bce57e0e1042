from __future__ import annotations

import hashlib
import json

import pytest

from linkharbor.llm import chat_format as chat
from linkharbor.llm.queries import QUERIES

NASTY = ["\\", "\\s", "\\l", "<", "</turn>\n", "<turn:assistant>\n", "\\\\<\\ls", "", ">\n", "é<\\", "😀<"]


def test_texts_and_roles_come_back_exactly(spark):
    rows = [(i, n, r, t) for i, t in enumerate(NASTY) for n, r in enumerate(["user", "assistant", t])]
    turns = spark.createDataFrame(rows, "conv_id long, ord long, role string, text string")
    back = chat.read_turns(chat.format_turns(turns)).collect()
    assert sorted((r["conv_id"], r["ord"], r["role"], r["text"]) for r in back) == sorted(rows)
    assert all(r["trained"] == (r["text"] if r["role"] == "assistant" else "") for r in back)


def test_layouts_become_the_same_turns(spark):
    q, a = "why <b>?", "be\\cause"
    records = [
        {"messages": [{"role": "user", "content": q}, {"role": "assistant", "content": a}]},
        {"messages": [{"text": q, "role": "user"}, {"text": a, "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": q}, {"from": "gpt", "value": a}]},
        {"response": a, "prompt": q},
        {"prompt": q, "completion": a},
        {"instruction": q, "output": a},
        {"instruction": q, "input": "", "output": a},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    turns = chat.turns_of_records(df, "conv_id", "record")
    assert sorted((r["conv_id"], r["ord"], r["role"], r["text"]) for r in turns.collect()) == sorted(
        (i, n, role, text) for i in range(len(records)) for n, (role, text) in enumerate([("user", q), ("assistant", a)])
    )
    with_input = json.dumps({"instruction": "sum", "input": "1 2", "output": "3"})
    df = spark.createDataFrame([(1, with_input)], "conv_id long, record string")
    assert chat.turns_of_records(df, "conv_id", "record").first()["text"] == "sum\n\n1 2"


def test_unknown_and_broken_records_are_told(spark):
    rows = [(1, None), (2, "no json"), (3, '{"a": 1}'), (4, "[]"), (5, '{"messages": []}'), (6, '{"prompt": null, "response": "x"}')]
    df = spark.createDataFrame(rows, "conv_id long, record string")
    found = {r["conv_id"]: r["known"] for r in chat.turns_of_records(df, "conv_id", "record").collect()}
    assert found == {1: False, 2: False, 3: False, 4: False, 5: False, 6: True}


def known(spark, *records):
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    return [r["known"] for r in chat.turns_of_records(df, "conv_id", "record").dropDuplicates(["conv_id"]).orderBy("conv_id").collect()]


def test_fields_of_other_names_and_any_depth_are_ignored(spark):
    pair = {"prompt": "p", "response": "r"}
    talk = [{"role": "user", "content": "q", "meta": {"tags": [{"deep": [1, "a", {"x": None}]}], "a, b: c": {}}}]
    assert known(
        spark, pair | {"my-id": 1}, pair | {"id": 1}, pair | {"x`y": {"prompt": []}, "": 2}, pair | {"n": [[{"response": 1}]]},
        {"messages": talk, "source": {"url": "u", "parts": [{"n": 1}]}}, {"turn": 3, "role": "user", "text": "t"},
    ) == [True] * 6


def test_fields_of_two_layouts_or_another_shape_are_unknown(spark):
    pair, talk = {"prompt": "p", "response": "r"}, [{"role": "user", "content": "q"}]
    assert known(
        spark, pair | {"messages": talk}, pair | {"messages": []}, pair | {"input": "x"}, {"prompt": ["p"], "response": "r"},
        {"messages": {"role": "user", "content": "q"}}, {"messages": [talk]}, {"messages[].role": "user", "messages[].content": "q"},
    ) == [False] * 7


def test_paths_of_a_record_and_of_its_typed_form_have_one_fingerprint(spark):
    for m in chat.MAPPINGS:
        record: dict = {"other": [{"x-y": 1}]}
        for path in m.paths:
            top, _, below = path.partition("[].")
            record[top] = [record.get(top, [{}])[0] | {below: "1"}] if below else "1"
        df = spark.createDataFrame([(1, json.dumps(record))], "conv_id long, record string")
        mark = df.select(chat.record_fingerprint(df["record"])).first()[0]
        typed = spark.read.json(df.select("record").rdd.map(lambda r: r[0]))
        assert mark == m.fingerprint == chat.mapping_of_frame(typed, "conv_id").fingerprint


def test_typed_frames_of_other_layouts(spark):
    rows = [(1, [("human", "q", 1), ("gpt", None, 2)], "x"), (2, [], "x"), (3, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, conversations array<struct<`from`: string, value: string, w: int>>, record string")
    assert sorted(tuple(r) for r in chat.turns_of_rows(df).collect()) == [(1, 0, "user", "q"), (1, 1, "assistant", "")]
    table = spark.createDataFrame([(1, 0, "user", "a", "p")], "conv_id long, turn long, role string, text string, prompt string")
    assert [tuple(r) for r in chat.turns_of_rows(table).collect()] == [(1, 0, "user", "a")]
    both = spark.createDataFrame([(1, "a", "b", "c")], "conv_id long, prompt string, response string, completion string")
    with pytest.raises(ValueError, match="no mapping"):
        chat.turns_of_rows(both)


def test_a_very_long_text(spark):
    text = "a<b\\" * 400_000
    df = spark.createDataFrame([(1, 0, "assistant", text)], "conv_id long, turn long, role string, text string")
    found = chat.conversation_digests(chat.read_turns(chat.format_turns(chat.turns_of_rows(df)))).first()
    assert (found["loss_chars"], found["loss_sha256"]) == (len(text), hashlib.sha256(text.encode()).hexdigest())


def test_rows_with_nulls_ties_and_more_columns(spark):
    rows = [(1, 0, None, None, "x"), (1, 1, "user", "b", "x"), (1, 1, "user", "a", "x"), (1, None, "assistant", "z", "x"), (None, 2, "assistant", "y", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ord string")
    digests = {r["conv_id"]: r for r in chat.conversation_digests(chat.read_turns(chat.format_turns(chat.turns_of_rows(df)))).collect()}
    spoken = "assistant\nz\n" + "\n\n" + "user\na\n" + "user\nb\n"
    assert digests[1]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
    assert (digests[1]["n_turns"], digests[1]["loss_chars"], digests[None]["loss_chars"]) == (4, 1, 1)
    assert digests[1]["loss_sha256"] == hashlib.sha256(b"z").hexdigest()
    whole = {r["conv_id"]: r["formatted"] for r in chat.join_pieces(chat.format_turns(chat.turns_of_rows(df))).collect()}
    assert len(whole[1]) == digests[1]["formatted_chars"]
    empty = chat.conversation_digests(chat.read_turns(chat.format_turns(chat.turns_of_rows(df.limit(0)))))
    assert empty.count() == 0
    with pytest.raises(ValueError, match="no mapping"):
        chat.turns_of_rows(df.drop("role"))


def test_registered_query_reads_back_the_control_conversation(spark):
    found = {r["conv_id"]: r for r in QUERIES["op3_chat_formatting"](spark, "/root/testdata/sf0.001").collect()}
    text = "\\### Assistant: </turn> ok"
    assert found[-7]["n_turns"] == 2
    assert found[-7]["loss_chars"] == len(text)
    assert found[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    plan = QUERIES["op3_chat_formatting"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

"""Chat formatting: layouts, round trips, the loss mask, and the query against its SQL."""

import hashlib
import json

import comparing
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabloom.llm import chat, queries

FOLDER = "/root/testdata/sf0.01"
PARTS = ["<|", "turn|>", "<|end|>\n", "\\", "<\\|", "</s>", "<s>", "[INST]", "[/INST]", "[\\INST]", "<", "[", "|", "a", "\n", "é👍",
         "<|turn|>assistant\n", "</\\s>", "<\\/s>", "/s>"]


def test_query_matches_sql(spark):
    df = queries.op7_chat_format(spark, FOLDER)
    assert comparing.difference(df, comparing.connect(FOLDER), queries.ORACLES["op7_chat_format"]) is None


def formatted(spark, records):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, record string").withColumn("at", F.lit("clash"))
    out = chat.format_turns(chat.canonical(df, "record"))
    return out.select(
        "i", "layout", "turns", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("back"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("taught"),
    ).orderBy("i").collect()


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=8).map("".join), min_size=30, max_size=60))
def test_texts_survive_the_template(spark, texts):
    messages = [{"role": "assistant" if i % 3 else "us\ner|%", "content": t} for i, t in enumerate(texts)]
    row = formatted(spark, [json.dumps({"messages": messages})])[0]
    assert [(t.role, t.text) for t in row.back] == [(m["role"], m["content"]) for m in messages]
    assert row.taught == "".join(t for i, t in enumerate(texts) if i % 3)
    pieces = [row.formatted[s.start : s.end] for s in row.loss]
    assert len(pieces) == sum(1 for i in range(len(texts)) if i % 3)
    for piece in pieces:
        assert not any(control in piece for control in chat.CONTROLS)
    assert row.formatted.count(chat.TURN) == row.formatted.count(chat.END) == len(texts)


def test_layouts(spark):
    records = {
        '{"messages":[{"role":"user","content":"q"},{"content":"a","role":"assistant"}]}': ("messages", "q", "a"),
        '{"id":3,"messages":[{"role":"user","content":"q"},{"name":"n","content":"a","role":"assistant"}]}': ("messages", "q", "a"),
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}': ("conversations", "q", "a"),
        '{"prompt":"q","response":"a"}': ("prompt_response", "q", "a"),
        '{"completion":"a","prompt":"q","source":"s"}': ("prompt_completion", "q", "a"),
        '{"instruction":"q","output":"a"}': ("instruction", "q", "a"),
        '{"question":"q","answer":{"text":"a"}}': ("question_answer", "q", "a"),
    }
    for row, (layout, *texts) in zip(formatted(spark, list(records)), records.values()):
        assert row.layout == layout
        assert [(t.role, t.text) for t in row.back] == [("user", texts[0]), ("assistant", texts[1])]
    rows = formatted(spark, ['{"instruction":"i","input":"x","output":"o"}', '{"system":"s","prompt":"q","response":"a"}'])
    assert [(t.role, t.text) for t in rows[0].back] == [("user", "i"), ("user", "x"), ("assistant", "o")]
    assert [t.role for t in rows[1].back] == ["system", "user", "assistant"]


def test_edge_cases(spark):
    records = [None, "", "no json", "[1]", '{"other":1}', '{"messages":[]}', '{"prompt":null,"response":null}',
               '{"messages":[{"role":null,"content":null}]}', '{"messages":[{"role":"user","content":"x"},"odd"]}',
               json.dumps({"prompt": "p", "response": "<|" * 200_000}), '{"prompt":"q","response":"a"}', '{"prompt":"q","response":"a"}']
    rows = formatted(spark, records)
    for row in rows[:5] + rows[8:9]:
        assert row.layout is None and row.turns is None and row.formatted is None
    assert rows[5].formatted == "" and rows[5].back == [] and rows[5].taught == ""
    assert [(t.role, t.text) for t in rows[6].back] == [("user", ""), ("assistant", "")]
    assert [(t.role, t.text) for t in rows[7].back] == [("", "")]
    assert rows[9].taught == "<|" * 200_000
    assert rows[10].formatted == rows[11].formatted
    assert chat.canonical(spark.createDataFrame([], "record string"), "record").collect() == []


def test_rows_with_ties_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 1, "user", "x"), (2, 5, "assistant", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("record", F.lit("clash"))
    records = chat.records_of_rows(df)
    out = {r.conv_id: r.turns for r in chat.canonical(records, "record").collect()}
    assert [t.text for t in out[1]] == ["", "a", "a", "b"] and [t.text for t in out[None]] == ["x"] and out[2][0].text == ""


@pytest.mark.parametrize("name", ["op7_chat_format"])
def test_plan_is_native(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_a_text_beyond_the_limits_of_a_variant(spark):
    long = "é\\\"a: " * 3_600_000
    records = [json.dumps({"prompt": "q", "response": long}),
               json.dumps({"messages": [{"role": "user", "content": long}, {"role": "assistant", "content": '"x": \\'}]}),
               json.dumps({"question": "q", "answer": {"text": long}, "odd": 1})]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, record string")
    out = chat.canonical(df, "record").select(
        "i", "layout", F.transform("turns", lambda t: F.struct(t["role"], F.length(t["text"]), F.md5(t["text"]))).alias("turns")
    )
    rows = {r.i: r for r in out.collect()}
    digest = (len(long), hashlib.md5(long.encode()).hexdigest())
    tail = '"x": \\'
    assert rows[0].layout == "prompt_response" and [tuple(t)[1:] for t in rows[0].turns][1] == digest
    assert rows[1].layout == "messages"
    assert [tuple(t) for t in rows[1].turns] == [("user", *digest), ("assistant", len(tail), hashlib.md5(tail.encode()).hexdigest())]
    assert rows[2].layout is None and rows[2].turns is None


def test_broken_records_have_no_layout_at_any_size(spark, monkeypatch):
    good = '{"prompt": "a \\"b\\" é", "response": "ok\\n"}'
    records = [good, '{"prompt": "a", "response": "\\q"}', '{"prompt": "a\nb", "response": "ok"}', '{"prompt": "a", "response": "ok"',
               '{"prompt": "a", "response": "ok"} x', "", "nothing", None, '{"messages": [{"role": "user", "content": "\\q"}]}']
    df = spark.createDataFrame(list(enumerate(records)), "i int, record string")
    small = [(r.layout, r.turns) for r in chat.canonical(df, "record").orderBy("i").collect()]
    monkeypatch.setattr(chat, "LARGE", 0)
    large = [(r.layout, r.turns) for r in chat.canonical(df, "record").orderBy("i").collect()]
    assert small == large and [layout for layout, _ in small] == ["prompt_response", *[None] * 3, "prompt_response", *[None] * 4]
    assert [t.text for t in small[0][1]] == ['a "b" é', "ok\n"]

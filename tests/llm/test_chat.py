import hashlib
import json
import random

import duckdb
import pytest
from pyspark.sql import types as T

from accrualkit.llm import chat, queries

NASTY = ["", "\\", "###", "####", "</turn>", "\\</turn>", "### User:\n</turn>\n", "\\\\###\\", "a\n### Assistant:\nb", "<", "</turn", "é\U0001f600", "\\n"]


@pytest.mark.parametrize("text", NASTY)
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text


def test_random_conversations_round_trip():
    rng = random.Random(1)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "system", "", "Assistant", "a:\nb", "</turn>"]), "".join(rng.choice(["\\", "#", "###", "</turn>", "\n", "x", "<"]) for _ in range(rng.randint(0, 9)))) for _ in range(rng.randint(1, 6))]
        formatted = "".join(chat.heading(r) + chat.escape(t) + chat.END for r, t in turns)
        assert [(r, t) for r, t, _, _ in chat.parse_turns(formatted)] == turns


def test_broken_text_is_refused():
    with pytest.raises(ValueError):
        list(chat.parse_turns("### User:\nno end"))


RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "from_value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "dialogue": {"dialog": [{"speaker": "user", "text": "q"}, {"speaker": "bot", "text": "a"}]},
    "instruction_plain": {"instruction": "q", "input": "", "output": "a"},
    "instruction": {"system": "", "instruction": "q", "input": None, "output": "a"},
    "prompt_completion": {"prompt": "q", "completion": "a"},
    "prompt_response": {"prompt": "q", "response": "a"},
    "question_answer": {"question": "q", "answer": "a"},
}


@pytest.mark.parametrize("layout", RECORDS)
def test_layouts_of_records(layout):
    record = RECORDS[layout] | {"extra": {"nested": 1}, "id": 5}
    assert chat.select_layout(chat.value_paths(record)) == layout
    assert chat.record_turns(record, layout) == [("user", "q"), ("assistant", "a")]


def test_mixed_records_and_tables_agree(spark):
    lines = [(i, json.dumps(r)) for i, r in enumerate(RECORDS.values())] + [(90, "{"), (91, None), (92, '{"unheard": 1}'), (93, "[1]")]
    rows = chat.turns_from_json(spark.createDataFrame(lines, "id long, record string"), "id", "record").collect()
    for i, name in enumerate(RECORDS):
        assert [(r["role"], r["text"], r["layout"]) for r in rows if r["conv"] == i] == [("user", "q", name), ("assistant", "a", name)]
    assert {r["conv"]: (r["layout"], r["turn"]) for r in rows if r["conv"] >= 90} == {c: ("unknown", None) for c in (90, 91, 92, 93)}
    turn = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("messages", T.ArrayType(turn)), T.StructField("text", T.StringType())])
    table = spark.createDataFrame([(3, [("user", "q"), ("model", None)], "clash")], schema)
    assert [tuple(r) for r in chat.turns_from_table(table).collect()] == [(3, 0, "user", "q"), (3, 1, "assistant", "")]
    plain = spark.createDataFrame([(4, "do", "this", "done")], "conv_id long, instruction string, input string, output string")
    assert [tuple(r) for r in chat.turns_from_table(plain).collect()] == [(4, 0, "user", "do\n\nthis"), (4, 1, "assistant", "done")]
    with pytest.raises(ValueError):
        chat.turns_from_table(spark.createDataFrame([(1,)], "conv_id long"))


def test_formatting_and_reading_back(spark, monkeypatch):
    rng = random.Random(2)
    convs = {c: [(rng.choice(["user", "assistant"]), rng.choice(NASTY)) for _ in range(rng.randint(1, 9))] for c in range(40)}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    rows += [(None, 0, "assistant", None), (None, None, None, "x"), (50, 1, "user", "same"), (50, 1, "user", "same")]
    rows += [(60, i, "assistant", "y" * 1000) for i in range(2500)]  # several pieces
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, conv int, piece int")
    pieces = chat.format_turns(chat.turns_from_table(table)).cache()
    assert pieces.filter("conv = 60").count() > 1
    got = {r["conv"]: tuple(r)[1:5] for r in chat.read_back(pieces).collect()}
    convs |= {None: [("", "x"), ("assistant", "")], 50: [("user", "same")] * 2, 60: [("assistant", "y" * 1000)] * 2500}
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert got[c] == (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_turns(chat.turns_from_table(table.limit(0)))).count() == 0


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.execute(f"SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars FROM ({queries.ORACLES['op3_chat']})").fetchall()
    got = [tuple(r) for r in queries.op3_chat(spark, sf).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()]
    assert sorted(got) == sorted(want) and any(r[0] == -7 for r in got)


def test_records_that_cannot_be_read_are_unknown(spark):
    deep = '{"messages":' + '{"a":' * 3000 + "1" + "}" * 3001
    raw = ["[" * 100_000, "[" * 100_000 + "]" * 100_000, deep, '{"prompt": "\\ud800", "response": "x"}', "{", "null", "", None, '{"instruction": "q", "output": ' + "[" * 900 + "]" * 900 + "}"]
    good = json.dumps({"messages": [{"role": "user", "content": "q"}, None, 3, {"role": "assistant", "content": "a"}]})
    df = spark.createDataFrame(list(enumerate([*raw, good])), "id long, record string")
    rows = chat.turns_from_json(df, "id", "record").collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["conv"], []).append(r)
    assert all(by_id[i][0]["layout"] == "unknown" and by_id[i][0]["turn"] is None for i in range(len(raw) - 1))
    assert [(r["role"], r["text"]) for r in by_id[len(raw)]] == [("user", "q"), ("assistant", "a")]


def test_null_elements_of_a_list_are_no_turns(spark):
    df = spark.createDataFrame([(1, [("user", "q"), None, ("assistant", "a")])], "conv_id long, messages array<struct<role: string, content: string>>")
    rows = chat.turns_from_table(df).orderBy("turn").collect()
    assert [(r["turn"], r["role"], r["text"]) for r in rows] == [(0, "user", "q"), (1, "assistant", "a")]

import hashlib
import json

import pytest
from conftest_llm import by_sql, same_rows
from pyspark.sql import functions as F

from paddock.llm import chat_format as C

ROWS = [
    (1, 0, "user", "hi <b> \\l \\b \\\\ <turn:user>\n</turn>\n"), (1, 1, "assistant", "é\U0001f600 </turn>\n<turn:assistant>\n x"), (1, 2, "assistant", ""),
    (2, 1, "assistant", "later"), (2, 0, "system", None), (2, 1, "assistant", "later"),      # a repeated row
    (3, None, "user", "no number"), (3, 0, None, "no role"), (3, 0, "human", "tie"), (None, 0, "user", "no conversation"), (None, None, None, None),
    (4, 0, "we<ird>\n\\role", "x" * 100_000), (5, 0, "gpt", " \t\n"), (-9, 3, "user", "\\### Assistant: </turn> ok"),
]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture(scope="module")
def turn_rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in ("record", "print", "layout", "ord", "_v", "i")})


def probe(spark):
    return spark.createDataFrame([(json.dumps(C.PROBE),)], "record string")


def test_same_as_sql(spark, turn_rows):
    records = C.from_turn_rows(turn_rows).unionByName(probe(spark))
    same_rows(C.digests(spark, records), by_sql(C.oracle(), conversations=turn_rows.select("conv_id", "turn", "role", "text")))


def test_texts_come_back(spark, turn_rows):
    back = C.read_back(C.formatted(C.canonical_turns(spark, C.from_turn_rows(turn_rows))))
    got = {r["conv_id"]: r for r in back.collect()}
    assert [t["text"] for t in got[1]["turns"]] == [r[3] for r in ROWS if r[0] == 1] and got[1]["under"] == [ROWS[1][3], ""]
    assert got[1]["formatted"].count("</turn>") == 3 and got[1]["formatted"].count("<turn:") == 3
    assert [t["text"] for t in got[2]["turns"]] == ["", "later", "later"]
    assert got[4]["turns"][0]["role"] == ROWS[11][2] and got[5]["turns"][0]["role"] == "assistant"
    assert [t["text"] for t in got[3]["turns"]] == ["no number", "no role", "tie"]


def test_every_layout_becomes_turns(spark):
    def filled(x, path=""):
        if isinstance(x, dict):
            return {k: filled(v, k) for k, v in x.items()}
        if isinstance(x, list):
            return [filled(x[0]), filled(x[0])]
        return x if isinstance(x, int) else {"role": "assistant", "from": "gpt"}.get(path, f"the {path} <here>")

    records = []
    for i, (name, (example, _, _)) in enumerate(C.LAYOUTS.items()):
        records.append((json.dumps({**filled(example), "conv_id": i}),))
    records += [('{"conv_id": 99, "other": ""}',), ('{"conv_id": 98, "messages": [{"role": "", "content": {"deep": 1}}]}',)]
    df = spark.createDataFrame(records, "record string")
    turns = {}
    for r in C.canonical_turns(spark, df).orderBy("conv_id", "ord").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    want = {"turn rows": [("assistant", "the text <here>")], "messages": [("assistant", "the content <here>")] * 2,
            "conversations": [("assistant", "the value <here>")] * 2, "prompt": [("user", "the prompt <here>"), ("assistant", "the completion <here>")],
            "preference": [("user", "the prompt <here>"), ("assistant", "the chosen <here>")],
            "instruction": [("user", "the instruction <here>"), ("assistant", "the output <here>")],
            "instruction with input": [("user", "the instruction <here>"), ("user", "the input <here>"), ("assistant", "the output <here>")],
            "question": [("system", "the system <here>"), ("user", "the question <here>"), ("assistant", "the response <here>")]}
    assert turns == {i: want[name] for i, name in enumerate(C.LAYOUTS)}
    assert sorted(r["record"] for r in C.unknown(spark, df).collect()) == sorted(r[0] for r in records[-2:])


def test_null_leaves_do_not_change_the_layout(spark):
    df = spark.createDataFrame([('{"conv_id": null, "messages": [{"role": null, "content": "a"}, {"content": null, "role": "user"}]}',), ('{"conv_id": 1, "messages": []}',)], "record string")
    assert [(r["role"], r["text"]) for r in C.canonical_turns(spark, df).orderBy("ord").collect()] == [("", "a"), ("user", "")]


def test_probe(spark):
    text = C.PROBE["messages"][0]["content"]
    r = C.digests(spark, probe(spark)).first()
    assert (r["conv_id"], r["n_turns"], r["loss_chars"]) == (-7, 2, len(text))
    assert r["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_empty_table_and_plan(spark, turn_rows):
    assert C.digests(spark, C.from_turn_rows(spark.createDataFrame([], SCHEMA))).collect() == []
    plan = C.digests(spark, C.from_turn_rows(turn_rows))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

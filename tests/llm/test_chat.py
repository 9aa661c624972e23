import collections
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat

FOLDER = "/root/testdata/sf0.001"
USER, BOT = ("user", "u1"), ("assistant", "b1")
LAYOUTS = [
    ("turn int, role string, text string", [(0, "user", "u1"), (1, "assistant", "b1")]),
    ("messages array<struct<role string, content string>>", [([USER, BOT],)]),
    ("conversations array<struct<`from` string, value string>>", [([("human", "u1"), ("gpt", "b1")],)]),
    ("instruction string, output string", [("u1", "b1")]),
    ("instruction string, input string, output string", [("u1", None, "b1")]),
    ("prompt string, response string", [("u1", "b1")]),
    ("prompt string, completion string", [("u1", "b1")]),
]


@pytest.mark.parametrize("extra", ["", "input", "system", "text", "prompt", "messages"])
@pytest.mark.parametrize("schema, rows", LAYOUTS)
def test_every_layout_with_an_id_and_an_extra_field(spark, schema, rows, extra):
    names = schema.replace("`", "")
    if extra and extra in names:
        return
    df = spark.createDataFrame([("c", *r) for r in rows], f"conv_id string, {schema}")
    if extra:
        df = df.withColumn(extra, F.lit(None).cast("string"))
    turns = sorted((r.turn, r.role, r.text) for r in chat.canonical_turns(df).collect())
    expected = [(0, *USER), (1, *BOT)]
    if extra == "system" and "response" in schema:
        expected = [(0, "system", ""), (1, *USER), (2, *BOT)]
    assert turns == expected
    records = df.select("conv_id", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw"))
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_json(records, "raw").collect())
    assert got == [("c", *t) for t in expected]


def test_malformed_records(spark):
    raws = [
        None, "", "[]", "{", '{"a": 1}', '{"messages": []}', '{"messages": ["x"]}', '{"messages": [null, {"role": "a", "content": "b"}]}',
        '{"messages": [{"role": 3, "content": ["p", {"q": 1}]}]}', '{"turn": "x", "role": "a", "text": "b"}',
        '{"turn": true, "role": "a", "text": "b"}', '{"turn": 2, "role": null, "text": 1.5}', '{"turn": 99999999999, "role": "a", "text": "b"}',
        '{"prompt": "p", "response": "r", "messages": []}', "[" * 100_000,
    ]
    df = spark.createDataFrame(list(enumerate(raws)), "conv_id long, raw string")
    got = collections.defaultdict(list)
    for r in chat.canonical_json(df, "raw").collect():
        got[r.conv_id].append((r.turn, r.role, r.text))
    for i in (0, 1, 2, 3, 4, 6, 7, 9, 10, 12, 14):
        assert got[i] == [(-1, "unmapped", raws[i] or "")], raws[i]
    assert got[5] == [] and got[13] == []
    assert got[8] == [(0, "3", json.dumps(["p", {"q": 1}]))]
    assert got[11] == [(2, "", "1.5")]


def test_no_layout_no_rows_and_nulls(spark):
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.createDataFrame([(1, "x")], "conv_id int, other string"))
    empty = spark.createDataFrame([], "conv_id int, turn int, role string, text string, input string")
    assert chat.canonical_turns(empty).collect() == []
    assert chat.conversation_digests(chat.parsed(chat.formatted(chat.canonical_turns(empty)))).collect() == []
    odd = spark.createDataFrame(
        [(1, None), (2, [None, (7, None)])], "conv_id int, messages array<struct<role int, content string>>"
    )
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.canonical_turns(odd).collect())
    assert got == [(2, 0, "", ""), (2, 1, "7", "")]


def test_op6_over_its_table_and_the_control_conversation(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    folder = tmp_path / "sf"
    given.withColumn("input", F.lit("clash")).withColumn("messages", F.lit(1)).write.parquet(str(folder / "conversations.parquet"))
    said = "</s>[INST] ok [/INST]"
    turns = [(r.conv_id, r.turn, r.role, r.text or "") for r in given.collect()] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    by_conv = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        by_conv[conv].append((turn, role, text))
    escaped = lambda t: t.replace("\\", "\\\\").replace("<s>", "<\\s>").replace("</s>", "<\\/s>").replace("[INST]", "[\\INST]").replace("[/INST]", "[\\/INST]")
    wanted = {}
    for conv, rows in by_conv.items():
        rows.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        loss = "".join(t for _, r, t in rows if r == "assistant")
        chars = sum(len(f"<s>[INST]{escaped(r)}[/INST]{escaped(t)}</s>") for _, r, t in rows)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        wanted[conv] = (len(rows), sha(whole), len(loss), sha(loss), chars)
    for place in (FOLDER, str(folder)):
        got = {r.conv_id: tuple(r)[1:] for r in chat.op6_chat(spark, place).collect()}
        assert got == wanted

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tabsmith.llm import chat

HARD = [
    "", "plain", "\\### Assistant: </turn> ok", "</turn>\n", "ends in <", "/turn>", "\\", "\\\\-", "\\-", "#", "##", "###", "#####", "# # ##",
    "<\\/turn>", "### User: hi</turn>\n### Assistant: yes</turn>\n", "a\nb\r\n", ": :", "Ünïcödé 漢字 👍🏽 </turn>", "x" * 40_000,
    "\\" * 301 + "</" * 99, "\\;", "tab\t\x00\x0b", "=tool", "User", "assistant",
]


def brute_turn(role, text):
    safe = lambda s: s.replace("\\", "\\-").replace("</", "<\\/").replace("##", "#\\#")
    name = role.capitalize() if role in ("user", "assistant", "system") else "=" + safe(role).replace(":", "\\;")
    return f"### {name}: ", f"{safe(text)}", "</turn>\n"


def test_every_text_and_role_comes_back(spark):
    roles = [*HARD[:19], *HARD[20:], "user", "system", "tool"]
    convs = [[(r, t) for t in HARD] for r in roles] + [[], [("user", "x")], [("assistant", t) for t in HARD]]
    df = spark.createDataFrame([(k, [Row(role=r, text=t) for r, t in c]) for k, c in enumerate(convs)], f"k int, turns {chat.TURNS}")
    out = chat.format_turns(df).drop("turns")
    for row in chat.read_back(out).collect():
        conv = convs[row["k"]]
        assert [tuple(t) for t in row["turns"]] == conv
        assert row["learnt"] == "".join(t for r, t in conv if r == "assistant")
        parts = [brute_turn(r, t) for r, t in conv]
        assert row["formatted"] == "".join("".join(p) for p in parts)
        assert [tuple(m) for m in row["mask"]] == [(len(h), len(t), r == "assistant") for (h, t, _), (r, _) in zip(parts, conv)]
        at = 0
        for (h, t, end), m in zip(parts, row["mask"]):  # the mask alone finds every text
            assert row["formatted"][at + m["skip"]:at + m["skip"] + m["chars"]] == t
            at += m["skip"] + m["chars"] + len(end)
        assert at == len(row["formatted"])


RECORDS = [
    ({"prompt": "p", "completion": "c"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "completion": "c", "system": "s"}, "prompt", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "output": ""}, "instruction", [("user", "i"), ("assistant", "")]),
    ({"instruction": "i", "input": "in", "output": "o"}, "instruction", [("user", "i\n\nin"), ("assistant", "o")]),
    ({"question": "q", "answer": "a"}, "question", [("user", "q"), ("assistant", "a")]),
    ({"messages": [{"role": "user", "content": "x"}, {"role": "tool", "content": None}]}, "messages", [("user", "x"), ("tool", "")]),
    ({"messages": [{"role": None, "content": "x"}]}, "messages", [("", "x")]),
    ({"messages": [{"role": "user"}]}, "messages", [("user", "")]),
    ({"messages": []}, "messages", []),
    ({"conversations": [{"from": "human", "value": "x"}, {"from": "gpt", "value": "y"}, {"from": "other", "value": "z"}]},
     "from_value", [("user", "x"), ("assistant", "y"), ("other", "z")]),
    ({"prompt": "p"}, None, None),
    ({"prompt": "p", "completion": "c", "answer": "a"}, None, None),
    ({"messages": [{"role": "user", "content": "x", "name": "n"}]}, None, None),
    ({}, None, None),
]


def records(spark, rows):
    kind = ("prompt string, completion string, system string, instruction string, input string, output string, question string, "
            "answer string, messages array<struct<role: string, content: string, name: string>>, "
            "conversations array<struct<from: string, value: string>>, id string")
    lines = [json.dumps({**r, "id": f"id{k}"}) for k, (r, *_) in enumerate(rows)]
    df = spark.createDataFrame(list(enumerate(lines)), "k int, line string")
    return df.select("k", F.from_json("line", kind).alias("record"), F.lit("mine").alias("layout"), F.lit("also").alias("formatted"))


def test_layouts_are_found_by_their_fields(spark):
    got = chat.canonical(records(spark, RECORDS), ignored=["id"])
    assert got.columns == ["k", "record", "formatted", "layout", "turns"]
    for row in got.collect():
        _, layout, turns = RECORDS[row["k"]]
        assert row["layout"] == layout
        assert (None if row["turns"] is None else [tuple(t) for t in row["turns"]]) == turns
    written = chat.format_turns(got)
    assert written.columns.count("formatted") == 1
    assert {r["formatted"] for r in written.filter("turns is null").collect()} == {None}
    assert {r["formatted"] for r in written.filter("size(turns) = 0").collect()} == {""}
    # an id that is not ignored is a field like any other
    assert {r["layout"] for r in chat.canonical(records(spark, RECORDS)).collect()} == {None}
    assert chat.canonical(records(spark, RECORDS).limit(0), ignored=["id"]).count() == 0


def test_lists_of_parts_and_null_records(spark):
    kind = "messages array<struct<role: string, content: array<struct<type: string, text: string>>>>"
    lines = ['{"messages": [{"role": "user", "content": [{"text": "a"}, {"text": null}, {"text": "b"}]}, {"role": "assistant", "content": []}]}',
             "null", '{"messages": [{"role": "user", "content": null}]}']
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string").select(
        "k", F.from_json("line", kind).alias("record"))
    got = {r["k"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical(df).collect()}
    assert got == {0: ("message_parts", [("user", "ab"), ("assistant", "")]), 1: (None, None), 2: ("messages", [("user", "")])}


def test_two_layouts_with_the_same_fields_are_refused(spark):
    twice = (*chat.LAYOUTS, chat.Layout("again", (chat.Each("messages", "role", "content"),)))
    with pytest.raises(ValueError):
        chat.canonical(records(spark, RECORDS), layouts=twice)


def test_rows_are_gathered_in_order(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, "system", "s"), (2, 0, None, "x"), (2, 0, None, "x"), (2, 0, "a", "y"),
            (None, 5, "user", "null id"), (None, 4, "user", "too"), (3, 10, "user", "ten"), (3, 9, "user", "nine")]
    rows += [(9, k, "user", str(k)) for k in range(3000)]  # a third of all rows and more
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in chat.conversations_of(df).collect()}
    assert got.pop(9) == [("user", str(k)) for k in range(3000)]
    assert got == {
        1: [("system", "s"), ("user", ""), ("assistant", "b")], 2: [("", "x"), ("", "x"), ("a", "y")],
        None: [("user", "too"), ("user", "null id")], 3: [("user", "nine"), ("user", "ten")]}
    assert chat.conversations_of(df.limit(0)).count() == 0


def test_no_python_workers(spark, sf_dir):
    from tabsmith.llm.queries import op12_chat_formatting

    plan = op12_chat_formatting(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

import json
import re

import pytest
from pyspark.sql import functions as F

from litquarry import schemas
from litquarry.functions.templates import EXTRACTION_PROMPT
from litquarry.operators import chat
from litquarry.sources import sinks, tables


def samples(spark, *values):
    """Samples from Python objects, keyed by their place."""
    lines = [(i, json.dumps(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(lines, "id int, line string")
    return df.select("id", F.from_json("line", schemas.CHAT_SAMPLE).alias("s")).select("id", "s.*")


def repaired(spark, *values):
    got = chat.repair_outcomes(samples(spark, *values), "id").select("id", "status", F.to_json("messages").alias("m"), "tools")
    return [(r["status"], json.loads(r["m"]) if r["m"] else None, r["tools"]) for r in sorted(got.collect())]


def user(text):
    return {"role": "user", "content": text}


def assistant(text):
    return {"role": "assistant", "content": text}


def call(name, arguments="{}", **more):
    return {"role": "assistant", "function_call": {"name": name, "arguments": arguments}, **more}


def reply(name, text="found", role="function", **more):
    return {"role": role, "name": name, "content": text, **more}


def test_regular_sample_is_unchanged(spark):
    messages = [user("q"), assistant("a")]
    assert repaired(spark, {"messages": messages}) == [("kept", messages, None)]


def test_trailing_messages_are_cut_and_empty_samples_skipped(spark):
    got = repaired(
        spark,
        {"messages": [user("q"), assistant("a"), user("r"), user("s")]},
        {"messages": [user("q")]},
        {"messages": []},
        {"messages": [user("q"), assistant("")]},
        {"messages": [user("q"), {"role": "assistant", "text": "t", "content": ""}]},
        {"other": 1},
    )
    assert [s for s, _, _ in got] == ["kept", "skipped", "skipped", "skipped", "kept", "kept"]
    assert got[0][1] == [user("q"), assistant("a")]
    assert got[5][1] is None


def test_call_without_text_skips_its_sample(spark):
    got = repaired(spark, {"messages": [user("q"), call("f", content=""), reply("f"), assistant("a")]})
    assert got[0][0] == "skipped"


def test_call_with_text_becomes_a_linked_tool_call(spark):
    messages = [user("q"), call("f", '{"a":  1}', text="calling", content=""), reply("f"), assistant("a"), reply("f")]
    ((status, out, tools),) = repaired(spark, {"functions": [{"name": "f", "x": [1]}], "messages": messages})
    assert status == "kept"
    assert [json.loads(t) for t in tools] == [{"function": {"name": "f", "x": [1]}}]
    assert [m["role"] for m in out] == ["user", "assistant", "tool", "assistant"]
    assert "content" not in out[1] and out[1]["text"] == "calling"
    (made,) = out[1]["tool_calls"]
    assert json.loads(made["function"]["arguments"]) == {"a": 1}
    assert made["id"] == out[2]["tool_call_id"]
    assert re.fullmatch("[A-Za-z0-9]{9}", made["id"])


def test_given_call_id_is_kept(spark):
    messages = [user("q"), call("f", text="t"), reply("f", role="tool", tool_call_id="abc"), assistant("a")]
    out = repaired(spark, {"messages": messages})[0][1]
    assert out[1]["tool_calls"][0]["id"] == out[2]["tool_call_id"] == "abc"


LINES = [
    {
        "messages": [
            {"role": "user", "content": "q é\u2028\"", "weight": 0, "meta": {"b": 1.0, "a": [1, None, "x"]}, "tag": "1"},
            {"role": "assistant", "content": "", "text": "calling", "function_call": {"name": "f", "arguments": '{"z": 1.0, "a": {"y": NaN}}'}},
            {"role": "function", "name": "f", "content": "found"},
            {"role": "assistant", "tool_calls": [{"id": "abcdefghi", "type": "function", "function": {"name": "g", "arguments": "{}"}}], "text": "t"},
            {"role": "tool", "name": "g", "content": "x", "tool_call_id": "abcdefghi"},
            {"role": "assistant", "content": "done", "refusal": None},
        ],
        "functions": [{"name": "f", "parameters": {"type": "object", "required": []}}, {"name": "g"}],
        "source": "made", "number": 12345678901234567890123, "flag": True,
    },
    {"messages": [{"role": "user", "content": "only"}, {"role": "assistant", "content": "a"}]},
    {"other": [1, 2]},
]


def test_written_samples_lose_nothing(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("\n".join(json.dumps(x) for x in LINES) + '\n{"messages": []} junk\n{"broken": \n[1]\n')
    read = tables.read_chat_lines(spark, str(tmp_path / "in.jsonl"))
    assert sorted(r["raw"] for r in read.filter("malformed").collect()) == ['[1]', '{"broken": ', '{"messages": []} junk']
    sinks.write_chat_lines(read.filter("not malformed"), str(tmp_path / "same"), "raw")
    again = [json.loads(line) for p in sorted((tmp_path / "same").glob("part-*")) for line in p.read_text().splitlines()]
    without_null = lambda x: {k: [without_null(v) if isinstance(v, dict) else v for v in x[k]] if k == "messages" else x[k] for k in x}
    assert sorted(map(repr, again)) == sorted(map(repr, map(without_null, again)))
    by_number = {str(x.get("number")) + str(x.get("other")): x for x in again}
    first = by_number["12345678901234567890123None"]
    expected = json.loads(json.dumps(LINES[0]))
    for message in [*first["messages"], *expected["messages"]]:
        call = message.get("function_call")
        if call:
            call["arguments"] = repr(json.loads(call["arguments"]))
    assert first == expected

    outcomes = chat.repair_outcomes(read, "raw")
    assert sorted(r["status"] for r in outcomes.collect()) == ["kept"] * 3 + ["malformed"] * 3
    sinks.write_chat_lines(chat.repair_chat(read, "raw"), str(tmp_path / "repaired"), "raw")
    lines = [json.loads(line) for p in sorted((tmp_path / "repaired").glob("part-*")) for line in p.read_text().splitlines()]
    (made,) = [x for x in lines if x.get("source") == "made"]
    assert [t["function"] for t in made["tools"]] == LINES[0]["functions"] and "functions" not in made
    assert made["number"] == 12345678901234567890123 and made["flag"] is True
    messages = made["messages"]
    assert messages[0] == LINES[0]["messages"][0]
    assert messages[1]["tool_calls"][0]["function"]["arguments"] == '{"z": 1.0, "a": {"y": NaN}}'
    assert messages[1]["tool_calls"][0]["id"] == messages[2]["tool_call_id"]
    assert messages[3]["tool_calls"][0] == LINES[0]["messages"][3]["tool_calls"][0]
    assert messages[5] == {"role": "assistant", "content": "done", "refusal": None}


@pytest.mark.parametrize("arguments, good", [
    ('{"b": 1.0, "a": 12345678901234567890123456789012345678901234567890}', True), ('{"a": 1, "a": 2}', True), ("null", True),
    (" [1] ", True), ('"text"', True), ("{} {}", False), ("{}, {}", False), ("{}] [{}", False), ("01", False), ("", False), ("{'a': 1}", False),
])
def test_arguments_stay_as_they_are(spark, arguments, good):
    messages = [user("q"), call("f", arguments, text="t"), assistant("a")]
    ((status, out, _),) = repaired(spark, {"messages": messages})
    assert status == ("kept" if good else "rejected")
    if good:
        assert json.loads(out[1]["tool_calls"][0]["function"]["arguments"]) == json.loads(arguments)


def test_rejected_samples(spark):
    got = repaired(
        spark,
        {"messages": [user("q"), call("f", text="t", content="not empty"), assistant("a")]},
        {"messages": [user("q"), call("f", "{broken", text="t"), assistant("a")]},
        {"messages": [user("q"), call("f", "{} x", text="t"), assistant("a")]},
        {"messages": [user("q"), call("f", text="t"), reply("g"), assistant("a")]},
    )
    assert [s for s, _, _ in got] == ["rejected"] * 4


def test_first_tool_message_does_not_look_at_the_last(spark):
    messages = [reply("g"), user("q"), call("f", text="t")]
    status, out, _ = repaired(spark, {"messages": messages})[0]
    assert status == "kept"
    assert "id" not in out[2]["tool_calls"][0]


def test_call_ids_do_not_depend_on_partitioning(spark):
    df = samples(spark, *[{"messages": [reply("g"), assistant(str(i))]} for i in range(20)])
    ids = [
        sorted((r["id"], r["messages"][0]["tool_call_id"]) for r in chat.repair_chat(df.repartition(n), "id").collect())
        for n in (1, 5)
    ]
    assert ids[0] == ids[1] and len({i for _, i in ids[0]}) == 20


def test_turns_are_repaired_per_conversation(spark):
    turns = [
        ("a", 0, "user", "q"), ("a", 1, "assistant", "r"), ("a", 2, "user", "more"),
        ("b", 0, "user", "q"), ("c", 0, "user", ""), ("c", 1, "assistant", "r"), ("d", 0, "assistant", None),
    ]
    df = spark.createDataFrame(turns, "conv_id string, turn int, role string, text string")
    assert sorted(tuple(r) for r in chat.repair_turns(df).collect()) == turns[:2]


def test_built_chat_equals_python(spark):
    data = [("x $1 [[[abstract]]]", None, "A"), (" \t", "d", "g"), (None, "d", "g"), ("é\"\\", 'L "q"', None)]
    df = spark.createDataFrame(data, "abstract string, disease_name string, gene string")
    got = chat.build_chat(df, EXTRACTION_PROMPT).select("messages").collect()
    expected = [
        [
            ("user", EXTRACTION_PROMPT.replace("[[[abstract]]]", a)),
            ("assistant", json.dumps({"Disease": d or "n/a", "Genes": g or "n/a"})),
        ]
        for a, d, g in (data[0], data[3])
    ]
    assert [[tuple(m) for m in r[0]] for r in got] == expected

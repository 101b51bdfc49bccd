"""Layouts, templates and loss masks: exact round trips."""

import hashlib
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketlens.llm import chat

NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user\n", "<;[;<;;", "a\\b\"c\n\n", "", "ü 東京 😀", "<", "[", ";", "<|turn|>"]


def rows(spark, conversations):
    flat = [(c, t, role, text, "clash") for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(flat, "conv_id long, turn long, role string, text string, turns string")


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def test_round_trip(spark):
    conversations = {
        1: [("user", NASTY[0]), ("assistant", NASTY[1])],
        2: [("system", None), ("user", NASTY[2]), ("assistant", NASTY[3])],
        3: [("user", NASTY[4]), ("assistant", NASTY[5]), ("user", NASTY[6]), ("assistant", NASTY[7])],
        4: [("assistant", NASTY[1]), ("assistant", NASTY[8]), ("tool\n<x>", NASTY[9])],
        5: [("user", "x" * 100_000)], 6: [("human", "not renamed"), ("gpt", "kept")], 7: [(None, "no role")],
        8: [("user,assistant", "one turn")], 9: [("system,user", "a"), ("assistant", "b")],
        **{k: [("user", NASTY[k % 10]), ("assistant", f"{k}"), ("user", NASTY[(k + 3) % 10])] for k in range(10, 30)},
    }
    table = rows(spark, conversations)
    more = table.filter("conv_id = 3 and turn = 1")
    records = chat.as_records(chat.gather_turns(table.unionByName(more)))
    turns = chat.canonical_turns(records, "record")
    assert {r["layout"] for r in turns.select("layout").distinct().collect()} == {"messages", "sharegpt", "prompt", "instruction"}
    formatted = chat.format_turns(turns.select("conv_id", "turns"))
    conversations[3].insert(1, conversations[3][1])
    found = {r["conv_id"]: r for r in chat.digests(chat.read_back(formatted)).collect()}
    for c, expected in conversations.items():
        pairs = [(role or "", text or "") for role, text in expected]
        loss = [text for role, text in pairs if role == "assistant"]
        got = found[c]
        assert got["n_turns"] == len(pairs)
        assert got["turns_sha256"] == digest(x + "\n" for pair in pairs for x in pair)
        assert (got["loss_chars"], got["loss_sha256"]) == (len("".join(loss)), digest(loss))
    for r in formatted.collect():
        # the marks of the template are the only ones
        assert r["formatted"].count(chat.TURN_BEGIN) == r["formatted"].count(chat.TURN_END) == len(conversations[r["conv_id"]])
        assert r["formatted"].count("[INST]") == 0


@settings(deadline=None, max_examples=5)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=30), min_size=1, max_size=40))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("e", chat.escape(F.col("text")))
    for r in df.withColumn("back", chat.unescape(F.col("e"))).collect():
        assert r["back"] == r["text"] and "<|" not in r["e"]


def test_fingerprints(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}]}, {"messages": [{"content": "b", "role": "user"}], },
        {"prompt": "p", "response": None}, {"response": "r", "prompt": "p", "extra": 1}, {"messages": []},
    ]
    df = spark.createDataFrame([(k, json.dumps(r)) for k, r in enumerate(records)], "k int, record string")
    found = {r["k"]: r for r in chat.canonical_turns(df, "record").collect()}
    assert [found[k]["layout"] for k in range(5)] == ["messages", "messages", "prompt", None, None]
    assert [tuple(t) for t in found[2]["turns"]] == [("user", "p"), ("assistant", "")]
    unknown = {r["paths"]: r["records"] for r in chat.unknown_layouts(df, "record").collect()}
    assert unknown == {"extra|prompt|response": 1, "messages": 1}


def test_paths_of_all_elements_and_objects(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b", "tool_calls": [{"name": "f"}]}]},
        {"prompt": {"text": "p"}, "response": "r"}, {"prompt": "p", "response": "r"}, {"a": [[{"b": 1}], [{"c": None}]], "a b": {"x:y": 1}},
    ]
    lines = [*map(json.dumps, records), "no json", None]
    df = spark.createDataFrame([(k, x, "mine") for k, x in enumerate(lines)], "k int, record string, fingerprint string")
    found = {r["k"]: r["p"] for r in df.select("k", chat.field_paths(F.col("record")).alias("p")).collect()}
    assert found[0] == sorted(["messages", "messages[].content", "messages[].role", "messages[].tool_calls", "messages[].tool_calls[].name"])
    assert found[1] == ["prompt", "prompt.text", "response"] and found[2] == ["prompt", "response"]
    assert {"a", "a[][].b", "a[][].c"} <= set(found[3])
    turns = {r["k"]: (r["layout"], r["fingerprint"]) for r in chat.canonical_turns(df, "record").collect()}
    assert [turns[k][0] for k in range(6)] == [None, None, "prompt", None, None, None] and all(f == "mine" for _, f in turns.values())
    assert sum(r["records"] for r in chat.unknown_layouts(df, "record").collect()) == 5


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    records = chat.as_records(chat.gather_turns(none))
    assert chat.digests(chat.read_back(chat.format_turns(chat.canonical_turns(records, "record").select("conv_id", "turns")))).count() == 0

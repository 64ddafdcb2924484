import json

import pytest

from orderloom.llm import chat

CALLS = "conversation string, call_id string, place long, name string, arguments string, " \
        "depends_on array<string>"
RESULTS = "conversation string, call_id string, place long, content string"
TOOLS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                 "properties": {"a": {"type": "integer", "minimum": 0},
                                "b": {"type": "array", "items": {"type": "string"}}}}}


def _run(spark, calls, results):
    found = chat.format_calls(spark.createDataFrame(calls, CALLS),
                              spark.createDataFrame(results, RESULTS), TOOLS)
    return sorted(found.collect(), key=lambda r: (r.conversation or "", r.position))


def _call(i, place, needs=(), conversation="c", arguments='{"a": 1}', name="add"):
    return conversation, i, place, name, arguments, list(needs)


def test_links_by_identifier(spark):
    rows = _run(spark, [_call("x", 0), _call("y", 2), _call("x", 4), _call(None, 5)],
                [("c", "x", 1, "second"), ("c", "x", 1, "first"), ("c", "z", 3, "lost"),
                 ("d", "y", 3, "other conversation"), ("c", None, 9, "no id")])
    assert [(r.call_id, r.status, r.answers) for r in rows if r.conversation == "c"] == [
        ("x", "linked", 2), ("y", "unanswered", 0), ("z", "orphan_result", 1),
        ("x", "repeated_id", 0), (None, "no_id", 0), (None, "orphan_result", 1)]
    assert json.loads(rows[0].message) == {
        "arguments": {"a": 1}, "id": "x", "name": "add", "result": "first"}


def test_order_follows_dependencies(spark, rng):
    nodes = list(range(25))
    rng.shuffle(nodes)
    calls = [_call(str(n), place, [str(m) for m in range(n) if rng.random() < 0.15])
             for place, n in enumerate(nodes)]
    rows = _run(spark, calls, [])
    at = {r.call_id: r.position for r in rows}
    assert sorted(at.values()) == list(range(25))
    assert all(at[need] < at[i] for _, i, _, _, _, needs in calls for need in needs)


def test_cycles_and_unknown_needs(spark):
    rows = {r.call_id: r for r in _run(spark, [
        _call("a", 0, ["b"]), _call("b", 1, ["a"]), _call("d", 2, ["a"]), _call("e", 3, ["e"]),
        _call("f", 4, ["gone"]), _call("g", 5, ["f"])], [])}
    assert {i for i, r in rows.items() if r.cyclic} == {"a", "b", "d", "e"}
    assert [rows[i].unknown_needs for i in "fg"] == [1, 0]


@pytest.mark.parametrize("arguments, name, found", [
    ('{"a": 2, "b": ["x"]}', "add", []),
    ('{"a": 2.0}', "add", []),
    ('{"a": -1, "c": 0}', "add", ["arguments.a: too small", "arguments.c: unknown"]),
    ('{"b": [1]}', "add", ["arguments.a: missing", "arguments.b[0]: not of type string"]),
    ('{"a": true}', "add", ["arguments.a: not of type integer"]),
    ("[]", "add", ["arguments: not of type object"]),
    ('{"a": 1, "a": 2}', "add", ["arguments: no JSON"]),
    ('{"a": NaN}', "add", ["arguments: no JSON"]),
    (None, "add", ["arguments: no JSON"]),
    ("{}", "none", ["unknown tool none"]),
])
def test_validation(arguments, name, found):
    message, errors = chat.serialise("i", name, arguments, None, "linked", TOOLS)
    assert errors == found
    assert message == chat.canonical(json.loads(message))


def test_repeated_rows_and_no_rows(spark):
    rows = _run(spark, [_call("x", 0), _call("x", 0)], [("c", "x", 1, "r"), ("c", "x", 1, "r")])
    assert [(r.status, r.answers) for r in rows] == [("linked", 2), ("repeated_id", 0)]
    assert _run(spark, [], []) == []


def test_one_long_conversation_is_numbered_over_many_tasks(spark):
    rows = _run(spark, [_call(f"i{n}", n, [f"i{n - 1}"] if n else []) for n in range(500)], [])
    assert [r.call_id for r in rows] == [f"i{n}" for n in range(500)]
    assert [r.position for r in rows] == list(range(500))


def test_derived_calls_wait_for_shorter_follow_ups(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "aaaa"), (1, 1, "assistant", "r"), (1, 2, "user", "bbb"),
         (1, 4, "user", "cc"), (1, 6, "user", "dd"), (1, 6, "user", "dd"), (1, 8, "user", None),
         (2, 0, "system", "s"), (2, 1, "user", "uu"), (2, 5, "user", ""), (2, 7, "tool", "t"),
         (None, 0, "user", "x")], "conv_id int, turn int, role string, text string")
    found = chat.format_calls(*chat.conversation_calls(turns), chat.TURN_TOOLS).collect()
    rows = sorted((r for r in found if r.conversation), key=lambda r: (r.conversation, r.position))
    assert [r.call_id[5:] for r in rows if r.status != "repeated_id"] == [
        "1_4", "1_2", "1_0", "1_8", "1_6", "2_0", "2_1", "2_5"]
    assert [r.status for r in rows].count("repeated_id") == 1
    assert not any(r.cyclic for r in rows)
    assert {r.call_id: r.unknown_needs for r in rows}["call_2_5"] == 1
    assert [r.status for r in found if r.conversation is None] == ["no_id"]

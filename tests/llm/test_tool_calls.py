import json

import pytest
from pyspark.sql import functions as F
from llm_fixtures import plan_of  # noqa: F401

from plumeledger.llm import tool_calls as c
from plumeledger.llm.shared import Scratch

CALL = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>"
RESULT = "conv_id long, call_id string, turn long, content string"


def linked(spark, calls, results=()):
    return c.link(spark.createDataFrame(list(calls), CALL), spark.createDataFrame(list(results), RESULT))


def test_link(spark, rows):
    calls = [(1, "a", 0, "f", "{}", None), (1, "a", 0, "f", "{}", None), (1, "a", 2, "g", "{}", None), (1, "b", 1, "f", None, []), (None, "a", 0, "f", "{}", None), (2, None, 0, "f", "{}", None)]
    results = [(1, "a", 1, "r"), (1, "a", 1, "r"), (1, "z", 3, "lost"), (None, "a", 1, "n")]
    found = linked(spark, calls, results).select("conv_id", "call_id", "name", "result", "status")
    assert sorted(map(repr, rows(found))) == sorted(map(repr, [
        (1, "a", "f", "r", "linked"), (1, "b", "f", None, "unanswered"), (1, "z", None, "lost", "orphan"),
        (None, "a", "f", None, "unanswered"), (2, None, "f", None, "unanswered"), (None, "a", None, "n", "orphan"),
    ]))
    assert rows(linked(spark, [])) == []


def test_order(spark):
    calls = [(1, f"t{i}", i, "f", "{}", [f"t{i - 1}"] if i else []) for i in range(4)]
    calls += [(2, "x", 0, "f", "{}", ["y"]), (2, "y", 1, "f", "{}", ["z", "z"]), (2, "z", 1, "f", "{}", None)]
    calls += [(3, "p", 0, "f", "{}", ["q"]), (3, "q", 1, "f", "{}", ["p"]), (3, "r", 2, "f", "{}", []), (3, "s", 3, "f", "{}", ["q"])]
    calls += [(4, "own", 0, "f", "{}", ["own"]), (5, "m", 0, "f", "{}", ["nowhere", "m2"]), (5, "m2", 1, "f", "{}", None)]
    scratch = Scratch(spark, "t")
    found = c.order(scratch.stage(linked(spark, calls)), scratch).collect()
    rank = {(r["conv_id"], r["call_id"]): r["rank"] for r in found}
    assert [rank[1, f"t{i}"] for i in range(4)] == [0, 1, 2, 3]
    assert [rank[2, k] for k in "zyx"] == [0, 1, 2]
    assert [rank[3, k] for k in "pqrs"] == [None, None, 0, None] and rank[4, "own"] is None
    assert {r["call_id"]: r["missing"] for r in found if r["missing"]} == {"m": 1}
    assert (rank[5, "m2"], rank[5, "m"]) == (0, 1)


SCHEMAS = {
    "f": {
        "properties": {
            "s": {"type": "string", "minLength": 2}, "i": {"type": "integer", "minimum": 0, "maximum": 9},
            "n": {"type": "number"}, "b": {"type": "boolean"}, "l": {"type": "array"}, "o": {"type": "object"},
            "e": {"type": "string", "enum": ["x", "y"]},
        },
        "required": ["s"], "additionalProperties": False,
    }
}


@pytest.mark.parametrize(
    ("name", "arguments", "errors"),
    [
        ("f", '{"s": "ab"}', []),
        ("f", '{"s": "ab", "i": 3.0, "n": 1e3, "b": false, "l": [1], "o": {"k": null}, "e": "y"}', []),
        ("f", '{"s": "a", "i": 10, "e": "z"}', ["maximum of i", "length of s", "value of e"]),
        ("f", '{"i": 1.5, "n": "1", "b": 0, "l": {}, "o": []}', ["missing s", "type of b", "type of i", "type of l", "type of n", "type of o"]),
        ("f", '{"s": "ab", "more": 1}', ["unexpected field"]),
        ("f", '{"s": null}', ["type of s"]),
        ("f", "[1]", ["not an object"]),
        ("f", '{"s": "ab", "s": "cd"}', ["not JSON"]),
        ("f", "{", ["not JSON"]),
        ("f", None, ["not JSON"]),
        ("g", "{}", ["unknown tool"]),
        (None, "{}", ["unknown tool"]),
    ],
)
def test_validate(spark, name, arguments, errors):
    df = spark.createDataFrame([(name, arguments)], "name string, arguments string")
    assert sorted(c.validate(df, SCHEMAS).first()["errors"]) == sorted(errors)


def test_canonical(spark):
    texts = {'{ "b" : 1 , "a" : [ 1.50, "x\\u00e9\\n", null ] }': '{"a":[1.5,"xé\\n",null],"b":1}', "{}": "{}", "x": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = dict(df.select("t", c.canonical(F.col("t"))).collect())
    assert found == texts


def test_messages_are_json(spark):
    calls = [(1, "a", 0, "f", '{"s": "q\\"uote"}', None), (1, "b", 1, "f", "broken", None)]
    found = c.serialise(linked(spark, calls, [(1, "a", 1, 'r"\n'), (1, "z", 2, "t")])).collect()
    messages = {r["call_id"]: r["message"] for r in found}
    assert json.loads(messages["a"]) == {"arguments": {"s": 'q"uote'}, "id": "a", "name": "f", "result": 'r"\n'}
    assert json.loads(messages["b"]) == {"arguments_text": "broken", "id": "b", "name": "f"}
    assert messages["z"] == '{"id":"z","result":"t"}'


def test_odd_conversations(spark):
    rows = [(1, 0, "system", None), (1, 1, "user", ""), (1, 2, "assistant", None), (None, 0, "user", "x"), (1, None, "user", "y"), (1, 1, "user", ""), (2, 0, None, "z"), (2, 1, "assistant", "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as status", "1 as rank")
    found = c.format_calls(*c.calls_of_turns(df), c.TURN_SCHEMAS)
    status = sorted((r["status"], r["name"] or "") for r in found.collect())
    assert status == [("linked", "respond"), ("orphan", ""), ("unanswered", "configure"), ("unanswered", "respond"), ("unanswered", "respond")]
    assert c.format_calls(*c.calls_of_turns(df.limit(0)), c.TURN_SCHEMAS).collect() == []
    assert "Python" not in plan_of(found)


def test_turns_of_other_roles_are_rows_of_their_own(spark):
    rows = [(1, 0, "user", "one two three four five"), (1, 1, "assistant", "yes"), (1, 2, None, "x"), (1, 3, "tool", None), (None, 4, "User", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    found = c.format_turns(df, c.TURN_SCHEMAS).collect()
    other = [(r["conv_id"], r["turn"], r["errors"], r["message"]) for r in found if r["status"] == "no role"]
    assert sorted(other, key=lambda x: x[1]) == [(1, 2, ["no role"], '{"text":"x"}'), (1, 3, ["no role"], None), (None, 4, ["no role"], '{"text":"y"}')]
    assert len(found) == 4

"""Tool calls of conversations: link, order, validate and serialise; DataFrame functions only.

* ``link`` joins calls and results on their identifiers, with Spark's hash joins or, where
  both sides are large, sort-merge joins that it can split.
* ``order`` ranks calls so that each comes after those it depends on. Where every dependency
  lies in an earlier turn, the turn is the rank and nothing is computed; only conversations
  with other dependencies are peeled off round by round (as many rounds as their longest
  chain). Calls that depend on themselves, directly or not, or on such calls, get no rank.
* ``validate`` checks arguments against a schema per tool and lists what is wrong.
* ``canonical`` writes a JSON text with sorted keys, without blanks and with plain numbers.

No step gathers a conversation: ranks are columns to sort by, so a conversation that holds a
third of all rows is spread like any other. Defined results: repeated calls of one
identifier count once (the smallest by turn, name and arguments), as do repeated results;
null identifiers link with nothing; null or broken JSON is invalid; an unknown tool is
invalid; empty tables give empty results; columns not named are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

KEYS = ["conv_id", "call_id"]


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per call or orphaned result: ``conv_id, call_id, turn, name, arguments,
    depends_on, result, status``; status is ``linked``, ``unanswered`` or ``orphan``."""
    call = F.struct("turn", "name", "arguments", "depends_on")
    calls = calls.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"),
        F.col("turn").cast("long").alias("turn"), F.col("name").cast("string").alias("name"),
        F.col("arguments").cast("string").alias("arguments"),
        F.coalesce(F.col("depends_on").cast("array<string>"), F.array().cast("array<string>")).alias("depends_on"),
    )
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    once = calls.where(known).groupBy(*KEYS).agg(F.min(call).alias("call"))
    once = once.unionByName(calls.where(~known).select(*KEYS, call.alias("call")))
    results = results.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("call_id").cast("string").alias("call_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), F.col("content").cast("string").alias("content")).alias("result"),
    )
    answers = results.where(known).groupBy(*KEYS).agg(F.min("result").alias("result"))
    answers = answers.unionByName(results.where(~known))
    both = once.join(answers, KEYS, "full")
    status = F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "unanswered").otherwise("linked")
    return both.select(
        *KEYS, F.coalesce("call.turn", "result.turn").alias("turn"), "call.name", "call.arguments",
        "call.depends_on", F.col("result.content").alias("result"), status.alias("status"),
    )


def order(linked: DataFrame, scratch: Scratch) -> DataFrame:
    """``linked`` plus ``rank`` and ``missing``, the dependencies that no call answers to.

    Within a conversation, sorting by ``rank``, ``turn`` and ``call_id`` is a topological
    order; orphaned results keep their turn as rank.
    """
    calls = linked.where("status <> 'orphan' and conv_id is not null and call_id is not null")
    edges = calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("depends_on")).alias("needs"))
    targets = calls.select("conv_id", F.col("call_id").alias("needs"), F.col("turn").alias("needed_turn"))
    edges = scratch.stage(edges.join(targets.withColumn("there", F.lit(True)), ["conv_id", "needs"], "left"))
    lost = edges.where("there is null").groupBy(*KEYS).agg(F.count("*").alias("missing"))
    real = edges.where("there")
    forward = scratch.stage(
        real.where("needed_turn is null or turn is null or needed_turn >= turn").select("conv_id").distinct()
    )
    out = linked.join(lost, KEYS, "left").withColumn("missing", F.coalesce("missing", F.lit(0)).cast("int"))
    if forward.isEmpty():
        return out.withColumn("rank", F.col("turn"))
    todo = scratch.stage(calls.join(forward, "conv_id", "left_semi").select(*KEYS))
    waits = scratch.stage(real.join(forward, "conv_id", "left_semi").select(*KEYS, "needs"))
    ranked, rank = None, 0
    while True:
        ready = scratch.stage(todo.join(waits, KEYS, "left_anti").withColumn("round", F.lit(rank).cast("long")))
        if ready.isEmpty():
            break
        ranked = ready if ranked is None else scratch.stage(ranked.unionByName(ready))
        done = ready.select(*KEYS)
        todo = scratch.stage(todo.join(done, KEYS, "left_anti"))
        waits = scratch.stage(waits.join(done.withColumnRenamed("call_id", "needs"), ["conv_id", "needs"], "left_anti"))
        rank += 1
    out = out.join(forward.withColumn("peeled", F.lit(True)), "conv_id", "left")
    if ranked is None:
        out = out.withColumn("round", F.lit(None).cast("long"))
    else:
        out = out.join(ranked, KEYS, "left")
    peeled = F.coalesce("peeled", F.lit(False)) & (F.col("status") != "orphan")
    return out.withColumn("rank", F.when(peeled, F.col("round")).otherwise(F.col("turn"))).drop("peeled", "round")


def canonical(json_text: Column) -> Column:
    """The JSON text with sorted keys and without blanks; null if it is no JSON or repeats a key."""
    return F.to_json(F.try_parse_json(json_text))


def _problems(value: Column, raw: Column, schema: dict) -> list[Column]:
    """For every rule of an object schema, its complaint or null."""
    out = []
    rules = schema.get("properties", {})
    required = set(schema.get("required", ()))
    for name, rule in sorted(rules.items()):
        part = F.variant_get(value, "$." + name if name.isidentifier() else f"$['{name}']", "variant")
        kind = F.schema_of_variant(part)
        there = part.isNotNull()
        number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
        as_number = F.when(number, F.try_variant_get(value, f"$.{name}", "double"))
        right = {
            "string": kind == "STRING", "boolean": kind == "BOOLEAN", "number": number,
            "integer": number & (as_number == F.floor(as_number)), "null": kind == "VOID",
            "array": kind.startswith("ARRAY"), "object": kind.startswith("OBJECT"),
        }[rule["type"]]
        if name in required:
            out.append(F.when(~there, f"missing {name}"))
        out.append(F.when(there & ~right, f"type of {name}"))
        text = F.when(kind == "STRING", F.try_variant_get(value, f"$.{name}", "string"))
        if "minimum" in rule:
            out.append(F.when(as_number < rule["minimum"], f"minimum of {name}"))
        if "maximum" in rule:
            out.append(F.when(as_number > rule["maximum"], f"maximum of {name}"))
        if "minLength" in rule:
            out.append(F.when(F.char_length(text) < rule["minLength"], f"length of {name}"))
        if "enum" in rule:
            out.append(F.when(there & ~F.coalesce(text.isin(*rule["enum"]), F.lit(False)), f"value of {name}"))
    if schema.get("additionalProperties", True) is False:
        known = F.array(*[F.lit(n) for n in sorted(rules)]).cast("array<string>")
        out.append(F.when(F.size(F.array_except(F.json_object_keys(raw), known)) > 0, "unexpected field"))
    return out


def validate(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``calls`` plus ``errors``: what is wrong with ``arguments`` under the schema of ``name``.

    Schemas are JSON schemas of one level: ``properties`` with ``type``, ``minimum``,
    ``maximum``, ``minLength`` and ``enum``; ``required``; ``additionalProperties``.
    """
    raw = F.col("arguments")
    df = calls.withColumn("__value", F.try_parse_json(raw))
    value = F.col("__value")
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    errors = F.array(F.lit("unknown tool"))
    for name, schema in sorted(schemas.items()):
        found = F.array(*_problems(value, raw, schema), F.lit(None).cast("string"))
        errors = F.when(F.col("name") == name, F.array_compact(found)).otherwise(errors)
    errors = F.when(value.isNull(), F.array(F.lit("not JSON"))).when(~is_object, F.array(F.lit("not an object"))).otherwise(errors)
    return df.withColumn("errors", errors).drop("__value")


def serialise(calls: DataFrame) -> DataFrame:
    """``calls`` plus ``message``: the call and its result as one canonical JSON object.

    Invalid arguments are written as the text they are, under ``arguments_text``."""
    arguments = canonical(F.col("arguments"))
    rest = F.to_json(
        F.struct(
            F.when(arguments.isNull(), F.col("arguments")).alias("arguments_text"),
            F.col("call_id").alias("id"), F.col("name"), F.col("result"),
        )
    )
    tail = F.substr(rest, F.lit(2))
    head = F.when(arguments.isNull(), "{").otherwise(
        F.concat(F.lit('{"arguments":'), arguments, F.when(tail == "}", "").otherwise(","))
    )
    return calls.withColumn("message", F.concat(head, tail))


#: Tools of the turns of a plain conversation, see ``calls_of_turns``.
TURN_SCHEMAS = json.loads(
    """{
  "configure": {"properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0},
    "words": {"type": "integer", "minimum": 1}}, "required": ["text", "turn", "words"], "additionalProperties": false},
  "respond": {"properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0},
    "words": {"type": "integer", "minimum": 5, "maximum": 60}}, "required": ["text", "turn", "words"],
    "additionalProperties": false}
}"""
)


def calls_of_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a conversation's turns stand for.

    A user's turn calls ``respond``, a system turn calls ``configure``; the assistant's turn
    after either is the result. A user's call depends on the calls of the two turns before.
    Turns of other roles, or of none, are neither: see ``format_turns``.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    name = lambda turn: F.concat(F.lit("c"), "conv_id", F.lit("-t"), turn)
    words = F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    given = F.struct(words.alias("words"), "turn", "text")
    calls = turns.where("role in ('user', 'system')").select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn",
        F.when(F.col("role") == "user", "respond").otherwise("configure").alias("name"),
        F.to_json(given).alias("arguments"),
        F.when((F.col("role") == "user") & (F.col("turn") > 0),
            F.filter(F.array(name(F.col("turn") - 2), F.when(F.col("turn") == 1, name(F.col("turn") - 1))),
                lambda x: x.isNotNull() & ~x.contains("-t-")),
        ).alias("depends_on"),
    )
    results = turns.where("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Linked, ordered and validated calls with their canonical ``message``."""
    scratch = Scratch(calls.sparkSession, "calls")
    ordered = order(scratch.stage(link(calls, results)), scratch)
    checked = validate(ordered, schemas)
    errors = F.when(F.col("status") == "orphan", F.array(F.lit("no call"))).otherwise(F.col("errors"))
    errors = F.when(F.col("missing") > 0, F.array_append(errors, F.lit("missing dependency"))).otherwise(errors)
    return serialise(checked.withColumn("errors", errors))


def format_turns(conversations: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``format_calls`` of ``calls_of_turns``, and one row of status ``no role`` for every turn
    whose role is null or none of user, system and assistant, its text as the message."""
    found = format_calls(*calls_of_turns(conversations), schemas)
    other = conversations.where(F.col("role").isNull() | ~F.col("role").cast("string").isin("user", "system", "assistant"))
    turn = F.col("turn").cast("long")
    message = F.when(F.col("text").isNotNull(), F.to_json(F.struct(F.col("text").cast("string").alias("text"))))
    rows = other.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), turn.alias("rank"),
        F.lit("no role").alias("status"), F.lit(0).alias("missing"), F.array(F.lit("no role")).alias("errors"),
        message.alias("message"),
    )
    return found.unionByName(rows, allowMissingColumns=True)

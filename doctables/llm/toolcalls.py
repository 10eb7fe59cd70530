"""Chat formatting: tool calls linked to results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on (conversation, call id). A call may come after another; its level is its distance from a call
without predecessor, found by doubling jumps along predecessors, so chains of any length take a logarithmic number of joins and no
conversation is gathered in one place. (level, pos) is a topological order of each conversation.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from doctables.llm import shared

TYPES = {"string": str, "integer": (int, float), "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}
KEY = ["conv_id", "call_id"]


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("a name occurs twice")
    return dict(pairs)


def _no_number(text: str) -> None:
    raise ValueError(f"{text} is no JSON")


def _is(value: object, kind: str) -> bool:
    if kind in ("integer", "number") and isinstance(value, bool):
        return False
    if kind == "integer" and isinstance(value, float):
        return value.is_integer()
    return isinstance(value, TYPES[kind])


def _mismatch(value: object, rule: dict, at: str) -> list[str]:
    """What is wrong with a value under a schema; goes as deep as the schema does. Rules of other types do not apply to a value."""
    kinds = rule.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}" if at else f"not {'an ' if kinds[0][0] in 'aeiou' else 'a '}{' or '.join(kinds)}"]
    found = []
    if "enum" in rule and value not in rule["enum"]:
        found.append(f"{at}: not allowed")
    if isinstance(value, str) and len(value) < rule.get("minLength", 0):
        found.append(f"{at}: too short")
    if "maximum" in rule and _is(value, "number") and value > rule["maximum"]:
        found.append(f"{at}: above {rule['maximum']}")
    if isinstance(value, dict):
        known = rule.get("properties", {})
        inner = f"{at}." if at else ""
        found += [f"{inner}{k}: missing" for k in rule.get("required", []) if k not in value]
        for k, v in sorted(value.items()):
            if k in known:
                found += _mismatch(v, known[k], inner + k)
            elif not rule.get("additionalProperties", True):
                found.append(f"{inner}{k}: not allowed")
    if isinstance(value, list) and "items" in rule:
        for i, v in enumerate(value):
            found += _mismatch(v, rule["items"], f"{at}[{i}]")
    return found


def faults(arguments: str | None, schema: dict | None) -> tuple[object, list[str]]:
    """(parsed arguments, what is wrong with them under a schema of type, properties, required, additionalProperties, items,
    enum, minLength and maximum). Names that occur twice, NaN and infinities are no JSON, nor is what nests too deeply to write again."""
    try:
        value = json.loads(arguments or "{}", object_pairs_hook=_pairs, parse_constant=_no_number)
        canonical(value)
    except (ValueError, RecursionError):
        return None, ["not JSON"]
    if schema is None:
        return value, ["unknown tool"]
    return value, _mismatch(value, {"type": "object", **schema}, "")


def canonical(value: object) -> str:
    """JSON with sorted keys, no blanks, and characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def levels(calls: DataFrame) -> DataFrame:
    """calls (conv_id, call_id, after) with level: 0 without a predecessor among the calls, null on or behind a cycle."""
    n = calls.count()
    known = calls.select("conv_id", F.col("call_id").alias("after"))
    real = calls.select(*KEY, "after").join(known.withColumn("there", F.lit(True)), ["conv_id", "after"], "left")
    state = real.select(*KEY, F.when(F.col("there"), F.col("after")).alias("jump"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("level"))
    state = shared.written(state, "levels")
    for _ in range(max(1, n).bit_length() + 1):
        if state.filter("jump is not null").isEmpty():
            break
        there = state.select("conv_id", F.col("call_id").alias("jump"), F.col("jump").alias("next"), F.col("level").alias("more"))
        moved = state.filter("jump is not null").join(there, ["conv_id", "jump"]).select(*KEY, F.col("next").alias("jump"), (F.col("level") + F.col("more")).alias("level"))
        state = shared.written(state.filter("jump is null").unionByName(moved), "levels")
    return calls.join(state.select(*KEY, F.when(F.col("jump").isNull(), F.col("level")).alias("level")), KEY, "left")


def linked_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """A row per call and per result without call: (conv_id, call_id, pos, level, status, n_results, valid, errors, json).

    calls: conv_id, call_id, pos, name, arguments (JSON text), after (a call_id or null); results: conv_id, call_id, pos, content. Extra columns are ignored.
    A call id that repeats in a conversation belongs to the call with the smallest pos (then name and arguments); others are `duplicate`. The first
    result by pos (then content) is the call's; n_results counts all. Calls without are `unanswered`, results without call `orphan`;
    null conversations and ids link with nothing. Null arguments are {}; a cycle has a null level and the error `cycle`.
    """
    calls = calls.select("conv_id", "call_id", "pos", "name", "arguments", "after")
    results = results.select("conv_id", "call_id", "pos", "content")
    row = F.row_number().over(Window.partitionBy(*KEY).orderBy("pos", "name", "arguments", "after"))
    marked = shared.written(calls.withColumn("turn_", F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), F.lit(1)).otherwise(row)), "calls")
    own = levels(marked.filter("turn_ = 1 and call_id is not null and conv_id is not null").drop("turn_"))
    first = results.filter("conv_id is not null and call_id is not null").groupBy(*KEY).agg(F.min(F.struct("pos", "content")).alias("r"), F.count("*").alias("n_results"))
    answered = own.join(first.hint("shuffle_hash"), KEY, "left").select("*", F.col("r.content").alias("result"), F.when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status")).drop("r")
    null_calls = marked.filter("turn_ > 1 or call_id is null or conv_id is null").withColumn("status", F.when(F.col("turn_") > 1, "duplicate").otherwise("unanswered")).drop("turn_")
    lost = results.join(own.select(*KEY).hint("shuffle_hash"), KEY, "left_anti").select(*KEY, "pos", F.col("content").alias("result"), F.lit("orphan").alias("status"))
    rows = answered.unionByName(null_calls, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    rows = rows.select(*KEY, "pos", "name", "arguments", "level", F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"), "result", "status")
    fields = {f.name: f.dataType.simpleString() for f in rows.schema}

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            valid, errors, texts = [], [], []
            for r in batch.to_pylist():
                if r["status"] == "orphan":
                    valid.append(None)
                    errors.append(None)
                    texts.append(canonical({"id": r["call_id"], "result": r["result"]}))
                    continue
                value, found = faults(r["arguments"], schemas.get(r["name"]))
                if r["status"] != "duplicate" and r["call_id"] is not None and r["conv_id"] is not None and r["level"] is None:
                    found.append("cycle")
                valid.append(not found)
                errors.append("; ".join(found))
                texts.append(canonical({"arguments": r["arguments"] if value is None else value, "id": r["call_id"], "name": r["name"], "result": r["result"]}))
            keep = [c for c in batch.schema.names if c in ("conv_id", "call_id", "pos", "level", "status", "n_results")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(valid, pa.bool_()), pa.array(errors, pa.string()), pa.array(texts, pa.string())], [*keep, "valid", "errors", "json"])

    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in ("conv_id", "call_id", "pos", "level", "n_results", "status")), "valid boolean, errors string, json string"])
    return rows.mapInArrow(write, schema)


#: Tools of the query: a reply has text and at most 200 words, a note text alone.
SCHEMAS = {
    "reply": {"properties": {"text": {"type": "string", "minLength": 1}, "words": {"type": "integer", "maximum": 200}}, "required": ["text", "words"], "additionalProperties": False},
    "note": {"properties": {"text": {"type": "string"}}, "required": ["text"], "additionalProperties": False},
}


def op6_tool_calls(spark, sf_dir):
    """Conversations as calls and results: assistant turns are calls that come after the call at about half their turn, user turns answer the turn before."""
    turns = shared.table(spark, sf_dir, "conversations")
    text = F.coalesce("text", F.lit(""))
    turn_id = lambda t: F.concat(F.lit("t"), t.cast("string"))
    arguments = F.to_json(F.struct(text.alias("text"), F.size(shared.words(text)).alias("words")))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", turn_id(F.col("turn")).alias("call_id"), F.col("turn").alias("pos"), F.when(F.col("turn") % 5 == 0, "note").otherwise("reply").alias("name"),
        arguments.alias("arguments"), F.when(F.col("turn") > 1, turn_id(F.floor(F.col("turn") / 4) * 2 + 1)).alias("after"),
    )
    calls = calls.withColumn("after", F.when(F.col("after") != F.col("call_id"), F.col("after")))
    results = turns.filter("role = 'user'").select("conv_id", turn_id(F.col("turn") - 1).alias("call_id"), F.col("turn").alias("pos"), text.alias("content"))
    return linked_calls(calls, results, SCHEMAS)

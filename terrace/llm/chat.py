"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

Calls and results meet in a hash join on conversation and identifier. A call may need the result of another (its
parent): how many calls precede it is found by pointer doubling, so a chain of any length takes as many joins as its
length has binary digits. The same doubling finds the last turn of all that a call needs, however far up and on whatever
turns it stands. Every message stays a row of its own; sorted by ``order_turn``, ``order_step`` and ``turn`` a
conversation is in topological order (a result after its call, a call after the calls it needs and all their results),
without gathering it in one task.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import stage

#: Doublings after which what still has a parent is a cycle: chains of up to 2^40 calls.
DOUBLINGS = 40
_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


# The keywords that are checked, and those that only describe.
KEYWORDS = {
    "type", "enum", "const", "required", "properties", "additionalProperties", "items", "minLength", "maxLength", "pattern",
    "minItems", "maxItems", "minimum", "maximum",
}
ANNOTATIONS = {"title", "description", "default", "examples", "$schema", "$id", "$comment"}


def check_schema(schema, at: str = "arguments") -> None:
    """Raise ``ValueError``, naming the place, for a schema that :func:`violations` does not know how to check in full."""
    if not isinstance(schema, dict):
        raise ValueError(f"{at}: a schema must be an object")
    if unknown := sorted(set(schema) - KEYWORDS - ANNOTATIONS):
        raise ValueError(f"{at}: unknown schema keywords {', '.join(unknown)}")
    if unknown := [str(k) for k in _kinds(schema) if k not in _TYPES]:
        raise ValueError(f"{at}: unknown types {', '.join(unknown)}")
    if not isinstance(schema.get("additionalProperties", True), bool):
        raise ValueError(f"{at}: additionalProperties must be true or false")
    try:
        re.compile(schema.get("pattern", ""))
    except re.error as e:
        raise ValueError(f"{at}: pattern {schema['pattern']!r}: {e}") from e
    for name, inner in schema.get("properties", {}).items():
        check_schema(inner, f"{at}.{name}")
    if "items" in schema:
        check_schema(schema["items"], f"{at}[]")


def _kinds(schema: dict) -> list:
    kinds = schema.get("type", [])
    return kinds if isinstance(kinds, list) else [kinds]


def _is(value, kind: str) -> bool:
    return isinstance(value, _TYPES[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def violations(value, schema: dict, at: str = "") -> list[str]:
    """What breaks a JSON schema of the keywords in :data:`KEYWORDS`; ``type`` is one type or a list of them."""
    kinds, where = _kinds(schema), at or "arguments"
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{where}: not {' or '.join(kinds)}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{where}: not allowed")
    if "const" in schema and value != schema["const"]:
        found.append(f"{where}: not allowed")
    if isinstance(value, (str, list)):
        least, most = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        found += [f"{where}: too short"] * (len(value) < schema.get(least, 0)) + [f"{where}: too long"] * (len(value) > schema.get(most, len(value)))
    if isinstance(value, str) and not re.search(schema.get("pattern", ""), value):
        found.append(f"{where}: other pattern")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{where}: too small"] * (value < schema.get("minimum", value)) + [f"{where}: too large"] * (value > schema.get("maximum", value))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], k)
            elif schema.get("additionalProperties") is False:
                found.append(f"{k}: unexpected")
    if isinstance(value, list) and "items" in schema:
        found += [e for k, v in enumerate(value) for e in violations(v, schema["items"], f"{where}[{k}]")]
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and no needless escapes."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def message(role, content, call_id, name, arguments, schemas: dict) -> tuple[str, list[str]]:
    """A message as canonical JSON, and what is wrong with its call."""
    body: dict = {"role": role, "content": content}
    errors: list[str] = []
    if name is not None:
        try:
            parsed = json.loads(arguments) if arguments is not None else {}
        except ValueError:
            parsed, errors = arguments, ["arguments: not JSON"]
        if not errors:
            errors = violations(parsed, schemas[name]) if name in schemas else ["name: unknown tool"]
        body["tool_calls"] = [{"id": call_id, "name": name, "arguments": parsed}]
    elif call_id is not None:
        body["tool_call_id"] = call_id
    return canonical(body), errors


def _depths(calls: DataFrame) -> DataFrame:
    """``(key, depth, need)`` of calls ``(key, parent_key, last)``: the calls before each and the greatest ``last`` among these.

    ``depth`` is null within or behind a cycle, and there ``need`` is null as well.
    """
    known = calls.select(F.col("key").alias("parent_key"), F.col("last").alias("need"), F.lit(True).alias("known"))
    state = calls.select("key", "parent_key").join(known, "parent_key", "left").select(
        "key", F.when(F.col("known"), F.col("parent_key")).alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth"), "need"
    )
    state = stage(state, "chat-depth")
    for _ in range(DOUBLINGS):
        if state.filter("up is not null").isEmpty():
            break
        above = state.select(F.col("key").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("need").alias("also"))
        further = state.join(above, "up", "left").select(
            "key", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.greatest("need", "also").alias("need")
        )
        before, state = state, stage(further, "chat-depth")
        if _open(before) == _open(state):  # every round ends some chain, so only cycles are left
            break
    return state.select("key", *[F.when(F.col("up").isNull(), F.col(c)).alias(c) for c in ("depth", "need")])


def _open(state: DataFrame) -> int:
    return state.filter("up is not null").count()


def format_chat(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """``(conv_id, turn, role, call_id, linked, depth, order_turn, order_step, valid, errors, json)``, one row per message.

    ``messages`` has ``conv_id, turn, role, content``, and for tool use ``call_id`` with ``name`` and JSON
    ``arguments`` (a call, with ``parent_id`` if it needs another's result) or without (a result). ``linked`` says
    whether a call has a result or a result its call; ``depth`` counts the calls before a call. ``errors`` lists, comma-joined, what breaks
    the schema of ``schemas[name]``, a result without a call, an identifier used by several calls, and a cycle; ``valid`` is
    whether there is none. ``order_turn`` is a message's turn or, if later, the last turn of what it needs: for a call all
    calls up its chain of parents and their results, for a result its call and all that this needs; ``order_step`` sorts
    what is so moved on one turn. Calls within or behind a cycle stay on their own turns. Calls that share an
    identifier have the least of their parents; their results follow the first of them, what needs them follows all. A schema
    with keywords that are not checked is refused by name (:func:`check_schema`). Nulls in any column stay nulls in the JSON (a null conversation is one of its own, a null
    turn sorts first); repeated rows stay; an empty table gives no rows; other columns are ignored.
    """
    for tool, schema in schemas.items():
        check_schema(schema, tool)
    key = lambda c: F.when(F.col(c).isNotNull(), F.concat_ws("/", F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.col(c)))
    rows = messages.select("conv_id", "turn", "role", "content", "call_id", "name", "arguments", key("call_id").alias("key"), key("parent_id").alias("parent_key"))
    is_call, is_result = "name is not null and key is not null", "name is null and key is not null"
    calls = rows.filter(is_call).groupBy("key").agg(F.min("turn").alias("call_turn"), F.max("turn").alias("last_call"), F.count("*").alias("n_calls"), F.min("parent_key").alias("parent_key"))
    results = rows.filter(is_result).groupBy("key").agg(F.count("*").alias("n_results"), F.max("turn").alias("last"))
    calls = stage(calls.join(results, "key", "left").withColumn("last", F.greatest("last_call", "last")), "chat-calls")
    depths = _depths(calls.select("key", "parent_key", "last"))
    facts = stage(calls.join(depths, "key").select("key", "call_turn", "n_calls", "n_results", "depth", "need"), "chat-facts")
    plain = rows.filter("key is null")
    for c in facts.columns[1:]:
        plain = plain.withColumn(c, F.lit(None).cast(dict(facts.dtypes)[c]))
    linked = rows.filter("key is not null").join(facts, "key", "left").unionByName(plain)
    call, result = F.expr(is_call), F.expr(is_result)
    graph = F.concat_ws(
        ",", F.when(result & F.col("n_calls").isNull(), F.lit("call: none")), F.when(call & (F.col("n_calls") > 1), F.lit("id: not unique")),
        F.when(call & F.col("depth").isNull(), F.lit("parent: cycle")),
    )
    # What stands on its own turn anyway is at step 0, what is moved behind others on the turn of the last of them at a
    # step of its own: calls of each depth, then their results.
    after = F.when(call, F.col("need")).when(result, F.greatest("call_turn", "need"))
    moved = 2 * F.coalesce("depth", F.lit(0)) + F.when(result & F.col("n_calls").isNotNull(), 1).otherwise(0)
    linked = linked.select(
        "conv_id", "turn", "role", "content", "call_id", "name", "arguments", graph.alias("graph"),
        F.when(call, F.col("n_results").isNotNull()).when(result, F.col("n_calls").isNotNull()).alias("linked"),
        F.when(call, F.col("depth")).alias("depth"), F.greatest("turn", after).cast("long").alias("order_turn"),
        F.when(F.col("turn").isNotNull() & (after.isNull() | (F.col("turn") > after)), F.lit(0)).otherwise(moved).cast("int").alias("order_step"),
    )

    def write(batches):
        for b in batches:
            kept = [b.column(i) for i in (0, 1, 2, 4, 8, 9, 10, 11)]
            got = [message(*values, schemas) for values in zip(*[b.column(i).to_pylist() for i in (2, 3, 4, 5, 6)])]
            errors = [",".join([*filter(None, [graph]), *e]) for graph, (_, e) in zip(b.column(7).to_pylist(), got)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array([not e for e in errors], pa.bool_()), pa.array(errors, pa.string()), pa.array([j for j, _ in got], pa.string())],
                ["conv_id", "turn", "role", "call_id", "linked", "depth", "order_turn", "order_step", "valid", "errors", "json"],
            )

    return linked.mapInArrow(
        write,
        f"conv_id {dict(rows.dtypes)['conv_id']}, turn {dict(rows.dtypes)['turn']}, role string, call_id string, linked boolean, depth long, order_turn long, "
        "order_step int, valid boolean, errors string, json string",
    )


# The tool by which plain turns are told as calls, and its schema.
REPLY = "reply"
SCHEMAS = {REPLY: {
    "type": "object", "additionalProperties": False, "required": ["prompt", "turn", "words"],
    "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "words": {"type": "integer", "minimum": 1, "maximum": 40}},
}}


def as_tool_use(conversations: DataFrame) -> DataFrame:
    """Plain ``(conv_id, turn, role, text)`` turns told as tool use, for :func:`format_chat`.

    A user turn calls :data:`REPLY` with its text, turn and number of words, and needs the reply to the user turn two
    turns before, if there is one; an assistant turn is the result of the call one turn before; other turns are plain.
    """
    text, turn = F.col("text").cast("string"), F.col("turn").cast("long")
    name = lambda t: F.concat(F.lit("call_"), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit("_"), t.cast("string"))
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    prompt = F.coalesce(text, F.lit(""))
    arguments = F.to_json(F.struct(prompt.alias("prompt"), turn.alias("turn"), F.size(F.regexp_extract_all(prompt, F.lit(r"[^ \t\n\r]+"), F.lit(0))).alias("words")))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.col("role").cast("string").alias("role"), text.alias("content"),
        F.when(user, name(turn)).when(assistant, name(turn - 1)).alias("call_id"), F.when(user, F.lit(REPLY)).alias("name"),
        F.when(user, arguments).alias("arguments"), F.when(user, name(turn - 2)).alias("parent_id"),
    )

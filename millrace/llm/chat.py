"""Chat formatting with tool-call linking.

A message is plain text, or JSON: an assistant's {"tool_calls": [{"id", "name", "arguments"}], "content"}, a tool's
{"tool_call_id", "content"}; a tool's may hold tool_calls of its own. A system message may declare the conversation's
tools: {"tools": [{"name", "parameters"}]}, also with each tool in {"type": "function", "function"}. Results are hash-joined to calls by conversation
and identifier, ordered after them, arguments are validated against JSON schemas, and every message becomes canonical
JSON: sorted keys, no spaces, no escapes but those that JSON needs.

Plain messages are a map over the rows. Only messages that look like tool traffic are joined, by (conv_id, call id), so
a conversation with a third of all rows is spread like any other; the order is a key on each message, which needs no
conversation in one place.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm._common import materialise, table

#: Numbers beyond this are no JSON values here, as they have no canonical form.
LARGEST = 1.7976931348623157e308
_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}
_KINDS = {*_TYPES, "integer", "number"}
#: The white space that JSON allows before an object.
JSON_SPACE = " \t\n\r"
#: Messages of a batch that the formatter passes on.
BATCH_ROWS = 2000


def canonical(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refuse(constant: str) -> None:
    raise ValueError(constant)


def _number(digits: str) -> float:
    value = float(digits)
    if abs(value) > LARGEST:
        _refuse(digits)
    return value


def parse_object(text: str | None) -> dict | None:
    """The JSON object that a text is, or None. What has no canonical form isn't taken as JSON: NaN, infinities,
    numbers beyond a double, half of a surrogate pair, nesting beyond Python's limit."""
    try:
        value = json.loads(text or "", parse_constant=_refuse, parse_float=_number)
        canonical(value).encode()
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return (isinstance(value, int) and not isinstance(value, bool)) or (isinstance(value, float) and value.is_integer())
    if kind == "number":
        return isinstance(value, (int, float)) and not isinstance(value, bool)
    return kind in _TYPES and isinstance(value, _TYPES[kind])


def violations(value: Any, schema: dict, where: str = "$") -> list[str]:
    """What value breaks of a JSON schema's type, enum, required, properties, additionalProperties and items."""
    kinds = schema.get("type")
    if unknown := {kinds} - _KINDS if isinstance(kinds, str) else set(kinds or ()) - _KINDS:
        raise TypeError(f"unknown types: {sorted(unknown)}")
    if kinds and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{where}: not of type {kinds if isinstance(kinds, str) else '/'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{where}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{where}: {k} is missing" for k in schema.get("required", ()) if k not in value]
        for k, v in value.items():
            if k in known:
                out += violations(v, known[k], f"{where}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{where}: {k} is unknown")
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for k, v in enumerate(value):
            out += violations(v, schema["items"], f"{where}[{k}]")
    return out


@lru_cache(maxsize=256)
def declared_tools(texts: tuple[str, ...]) -> dict[str, dict]:
    """The JSON schemas by tool name that system messages declare; the first of a name counts, and a tool without
    parameters takes any."""
    out: dict[str, dict] = {}
    for text in texts:
        listed = (parse_object(text) or {}).get("tools")
        for tool in listed if isinstance(listed, list) else []:
            tool = tool.get("function", tool) if isinstance(tool, dict) else None
            if isinstance(tool, dict) and isinstance(tool.get("name"), str):
                out.setdefault(tool["name"], tool.get("parameters") or {})
    return out


def read_calls(body: dict, schemas: dict[str, dict]) -> list[dict]:
    """The message's calls: id, name, arguments (decoded), check. Entries that aren't calls get check `malformed`."""
    out = []
    listed = body.get("tool_calls")
    for call in listed if isinstance(listed, list) else []:
        call = call if isinstance(call, dict) else {}
        name, call_id, arguments = call.get("name"), call.get("id"), call.get("arguments", {})
        if isinstance(arguments, str):
            arguments = parse_object(arguments)
        if not isinstance(name, str) or not isinstance(call_id, str) or not isinstance(arguments, dict):
            out.append({"id": call_id if isinstance(call_id, str) else None, "name": name if isinstance(name, str) else None, "arguments": call.get("arguments"), "check": "malformed"})
            continue
        try:
            broken = violations(arguments, schemas[name]) if name in schemas else []
        except (AttributeError, KeyError, TypeError):
            broken = ["malformed schema"]
        out.append({"id": call_id, "name": name, "arguments": arguments, "check": "unknown tool" if name not in schemas else "; ".join(broken) or "valid"})
    return out


def _plain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(low, BATCH_ROWS)
            rows = [canonical({"role": role, "content": text}) for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(rows, pa.string())], names=["conv_id", "turn", "role", "message"])


_TOOL = "conv_id bigint, turn bigint, role string, message string, result_of string, calls array<struct<id:string,name:string,check:string>>"
_CALLS = pa.list_(pa.struct([("id", pa.string()), ("name", pa.string()), ("check", pa.string())]))


def _tools(batches: Iterable[pa.RecordBatch], schemas: dict[str, dict]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, whole.num_rows, BATCH_ROWS):
            batch = whole.slice(low, BATCH_ROWS)
            messages, results, calls = [], [], []
            for role, text, declared in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4))):
                body = parse_object(text)
                listed = read_calls(body, schemas | declared_tools(tuple(declared or ()))) if body else []
                result = body.get("tool_call_id") if body and role == "tool" else None
                result = result if isinstance(result, str) else None
                message: dict[str, Any] = {"role": role, "content": body.get("content") if listed or result is not None else text}
                if listed:
                    message["tool_calls"] = [{k: c[k] for k in ("id", "name", "arguments")} for c in listed]
                if result is not None:
                    message["tool_call_id"] = result
                messages.append(canonical(message))
                results.append(result)
                calls.append([{k: c[k] for k in ("id", "name", "check")} for c in listed])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(messages, pa.string()), pa.array(results, pa.string()), pa.array(calls, _CALLS)], names=["conv_id", "turn", "role", "message", "result_of", "calls"])


def _ordered(results: DataFrame) -> DataFrame:
    """(rid, order_turn, order_depth) of results (rid, parent, turn, parent_turn): the latest turn on the way up from a
    result through the calls before it, and how many there are. Ways are doubled each round; a way that never ends is a
    cycle and has depth -1."""
    state = materialise(results.select("rid", F.col("parent").alias("up"), F.greatest("turn", "parent_turn").alias("t"), F.lit(1).alias("d")), "chat-order")
    limit = max(1, state.count()).bit_length() + 1
    for _ in range(limit):
        if state.where("up IS NOT NULL").isEmpty():
            break
        above = state.select(F.col("rid").alias("up"), F.col("up").alias("up2"), F.col("t").alias("t2"), F.col("d").alias("d2"))
        state = materialise(
            state.join(above, "up", "left").select("rid", F.col("up2").alias("up"), F.greatest("t", "t2").alias("t"), (F.col("d") + F.coalesce("d2", F.lit(0))).alias("d")),
            "chat-order",
        )
    return state.select("rid", F.when(F.col("up").isNull(), F.col("t")).alias("order_turn"), F.when(F.col("up").isNull(), F.col("d")).otherwise(-1).alias("order_depth"))


def _object_of(*roles: str) -> Column:
    return F.coalesce(F.col("role").isin(*roles) & F.ltrim("text", F.lit(JSON_SPACE)).startswith("{"), F.lit(False))


def _looks_like_tools() -> Column:
    return _object_of("assistant", "tool")


def format_chats(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """Returns a row per message (conv_id, turn, role, text; other columns are ignored) with

    message (canonical JSON), order_turn and order_depth (messages of a conversation sorted by these and turn have
    results after their calls), link (of a result: linked, orphan or cycle; else null) and calls (id, name, check,
    answered).

    The first call of an identifier, by turn, owns its results. A text that isn't a JSON object is plain content, also
    for assistants and tools; a null text is null content. Null conv_ids are one conversation. Repeated rows stay rows.
    Calls are checked against the tools that system messages of their conversation declare, before or after them (the
    first of a name, by turn, counts), then against schemas, which maps tool names to JSON schemas; calls of other tools
    are checked as `unknown tool`.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string"))
    nothing = "array<struct<id:string,name:string,check:string,answered:boolean>>"
    plain = rows.where(~_looks_like_tools()).mapInArrow(_plain, "conv_id bigint, turn bigint, role string, message string")
    plain = plain.select("conv_id", "turn", "role", F.col("turn").alias("order_turn"), F.lit(0).alias("order_depth"), F.lit(None).cast("string").alias("link"), F.expr(f"CAST(array() AS {nothing})").alias("calls"), "message")
    known = schemas or {}
    system = rows.where(_object_of("system")).groupBy(F.col("conv_id").alias("c")).agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("system"))
    called = rows.where(_looks_like_tools()).join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left").select("conv_id", "turn", "role", "text", F.col("system.text").alias("declared"))
    tools = materialise(called.mapInArrow(lambda b: _tools(b, known), _TOOL).withColumn("rid", F.monotonically_increasing_id()), "chat-tools")
    if tools.isEmpty():
        return plain
    each = tools.select("rid", "conv_id", "turn", F.posexplode("calls").alias("pos", "call"))
    owners = each.where("call.id IS NOT NULL").groupBy("conv_id", F.col("call.id").alias("id")).agg(F.min(F.struct("turn", "pos", "rid")).alias("o"))
    returned = tools.where("result_of IS NOT NULL").select("rid", F.col("conv_id").alias("c"), "turn", "result_of")
    linked = materialise(
        returned.join(owners, F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("result_of") == F.col("id")), "left").select("rid", "turn", F.col("o.rid").alias("parent"), F.col("o.turn").alias("parent_turn"), "o"), "chat-links"
    )
    order = _ordered(linked.where("parent IS NOT NULL").drop("o"))
    answered = linked.where("parent IS NOT NULL").select(F.col("o.rid").alias("rid"), F.col("o.pos").alias("pos")).distinct().withColumn("yes", F.lit(True))
    calls = each.join(answered, ["rid", "pos"], "left").groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("pos", "call", F.coalesce("yes", F.lit(False)).alias("yes")))).alias("cs"))
    shown = F.transform("cs", lambda c: F.struct(c["call"]["id"].alias("id"), c["call"]["name"].alias("name"), c["call"]["check"].alias("check"), c["yes"].alias("answered")))
    joined = tools.drop("calls").join(calls, "rid", "left").join(order, "rid", "left")
    link = F.when(F.col("result_of").isNotNull(), F.when(F.col("order_depth") > 0, "linked").when(F.col("order_depth") < 0, "cycle").otherwise("orphan"))
    traffic = joined.select("conv_id", "turn", "role", F.coalesce("order_turn", "turn").alias("order_turn"), F.greatest(F.coalesce("order_depth", F.lit(0)), F.lit(0)).alias("order_depth"), link.alias("link"), F.coalesce(shown, F.expr(f"CAST(array() AS {nothing})")).alias("calls"), "message")
    return plain.unionAll(traffic)


def op8_chat(spark, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "role", "order_turn", "order_depth", "link", F.size("calls").alias("n_calls"), "message")


def op8_chat_calls(spark, sf_dir: str) -> DataFrame:
    """A row per call, as op8_chat tells only how many a message has: conv_id, turn, pos, id, name, check, answered."""
    calls = format_chats(table(spark, sf_dir, "conversations")).select("conv_id", "turn", "role", F.posexplode("calls").alias("pos", "call"))
    return calls.select("conv_id", "turn", "role", "pos", "call.id", "call.name", "call.check", "call.answered")


#: For tables without tool traffic, which is tested by brute force.
OP8_SQL = """
SELECT conv_id, turn, role, turn AS order_turn, 0 AS order_depth, CAST(NULL AS VARCHAR) AS link, 0 AS n_calls,
       '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null') || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}' AS message
FROM conversations"""

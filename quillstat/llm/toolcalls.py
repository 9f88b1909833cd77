"""Chat formatting: tool-call linking (operator 3).

Calls and results are linked by a hash join on (conversation, identifier); calls
are ordered topologically; arguments are validated against the tool's schema;
each call becomes one line of canonical JSON.

* ``calls``: conv_id, call_id, name, arguments (JSON text), after (the call_id
  whose result this call uses, or null), turn.
* ``results``: conv_id, call_id, content, turn.
* schemas: a dict from tool name to a JSON schema (type, required, properties,
  additionalProperties, enum, minimum, maximum, minLength, items).

Order: a call's level is the length of its chain of ``after`` references, found
by pointer doubling (a conversation of n calls takes log2 n joins on
the identifiers, never a task per conversation); calls are given in the order of
level, turn, identifier.  A call on a cycle, or behind one, has a null level.
A reference to a call that is missing counts as none.

Canonical JSON: keys sorted, no spaces, UTF-8 unescaped, integral numbers
without a fraction.

Edge cases: null arguments or text that is not JSON (see ``checked``) are invalid and serialised as null; a
call of an unknown tool is invalid; of repeated calls of one identifier the
earliest turn (then least name and arguments) stands, and of repeated
results the earliest (then least content); calls with null conversation or
identifier are not linked and left out; a call without result has result null; a
result without call is left out; empty tables give no rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .shared import stash
from .textscan import column

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def valid(value, schema: dict) -> bool:
    """Whether a parsed JSON value keeps the schema."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer" and not (number and (isinstance(value, int) or value.is_integer())):
        return False
    if kind == "number" and not number:
        return False
    if kind in _TYPES and not isinstance(value, _TYPES[kind]):
        return False
    if "enum" in schema and not any(same(value, e) for e in schema["enum"]):
        return False
    if number and not schema.get("minimum", -math.inf) <= value <= schema.get("maximum", math.inf):
        return False
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        return False
    if isinstance(value, list) and "items" in schema:
        return all(valid(v, schema["items"]) for v in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", ())):
            return False
        if schema.get("additionalProperties", True) is False and any(k not in known for k in value):
            return False
        return all(valid(v, known[k]) for k, v in value.items() if k in known)
    return True


def same(a, b) -> bool:
    """Equality of JSON values: 1 is 1.0, but not true."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(v, b[k]) for k, v in a.items())
    return a == b


def _plain(value):
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() and abs(value) < 2**53 else value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def parse(text: str | None):
    """The JSON value, or None where the text is none (NaN and infinities are not JSON)."""
    def refuse(_):
        raise ValueError
    try:
        return None if text is None else json.loads(text, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None


def checked(text: str | None, schema: dict | None) -> tuple[str, bool]:
    """Canonical JSON of some arguments, and whether they keep the schema.

    What has no canonical form counts as text that is not JSON: lone surrogates,
    numbers beyond double range and values nested too deep for the parser.
    """
    try:
        value = parse(text)
        printed = canonical(value)
        printed.encode()
        return printed, value is not None and schema is not None and valid(value, schema)
    except (ValueError, OverflowError, RecursionError):
        return "null", False


def _formatter(schemas: dict):
    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "call_id", "level", "turn", "name", "arguments", "has_result", "result"]
        for batch in batches:
            ok, lines = [], []
            for conv, call, level, _, name, arguments, has, result in zip(*(column(batch, n).to_pylist() for n in names)):
                printed, good = checked(arguments, schemas.get(name))
                ok.append(good)
                lines.append(f'{{"arguments":{printed},"id":{canonical(call)},"name":{canonical(name)},"result":{canonical(result if has else None)},"valid":{canonical(good)}}}')
            cols = [column(batch, c) for c in ("conv_id", "call_id", "level", "turn", "name", "has_result")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(ok, pa.bool_()), pa.array(lines, pa.string())],
                                             names=["conv_id", "call_id", "level", "turn", "name", "has_result", "valid", "json"])
    return form


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, level: the number of calls before it on its chain; null on and behind a cycle.

    ``calls``: conv_id, call_id (distinct), after.
    """
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    at = calls.select("conv_id", "call_id", "after").join(known, ["conv_id", "after"], "left")
    at = stash(at.select("conv_id", "call_id", F.when(F.col("known"), F.col("after")).alias("to"))
               .withColumn("level", F.when(F.col("to").isNull(), 0).otherwise(1).cast("long")), "call-levels")
    longest = at.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(max(1, math.ceil(math.log2(longest + 1)))):
        step = at.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("level").alias("_level"))
        at = stash(at.join(step, ["conv_id", "to"], "left").select("conv_id", "call_id", F.col("_to").alias("to"), (F.col("level") + F.coalesce("_level", F.lit(0))).alias("level")), "call-levels")
        if at.where("to is not null").limit(1).count() == 0:
            break
    return at.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("level")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """conv_id, call_id, level, turn, name, has_result, valid, json: one row per call, by conversation in topological order."""
    ship_package(calls.sparkSession)
    clean = (calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id")
             .agg(F.min(F.struct(F.col("turn").isNull(), "turn", "name", "arguments", "after")).alias("c")).select("conv_id", "call_id", "c.turn", "c.name", "c.arguments", "c.after"))
    clean = stash(clean, "calls")
    answers = (results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id")
               .agg(F.min(F.struct(F.col("turn").isNull(), "turn", "content")).alias("r")).select("conv_id", "call_id", F.col("r.content").alias("result"), F.lit(True).alias("has_result")))
    joined = (clean.join(levels(clean), ["conv_id", "call_id"]).join(answers, ["conv_id", "call_id"], "left")
              .withColumn("has_result", F.coalesce("has_result", F.lit(False))))
    return (joined.select("conv_id", "call_id", "level", "turn", "name", "arguments", "has_result", "result")
            .mapInArrow(_formatter(schemas), "conv_id long, call_id string, level long, turn long, name string, has_result boolean, valid boolean, json string"))


def ordered(linked: DataFrame) -> DataFrame:
    """The linked calls sorted by conversation, level (cycles last), turn and identifier."""
    return linked.orderBy("conv_id", F.col("level").asc_nulls_last(), "turn", "call_id")


#: how turns are read as calls: what a user asks is a call of "reply", the turn after it its result
TURN_SCHEMAS = {"reply": {"type": "object", "required": ["prompt", "words"], "additionalProperties": False,
                          "properties": {"prompt": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 3}}}}


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of a table conv_id, turn, role, text.

    The call of a user turn has the identifier conv_id:turn and uses the
    result of the user turn two before, if that is one; an assistant turn is the
    result of the call one before.
    """
    c = conversations.select("conv_id", "turn", "role", "text")
    name = lambda back: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    arguments = F.to_json(F.struct(words.alias("words"), F.col("text").alias("prompt")), {"ignoreNullFields": "false"})
    calls = (c.where("role = 'user' and turn is not null").select("conv_id", name(0).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), name(2).alias("after"), "turn"))
    results = c.where("role = 'assistant' and turn is not null").select("conv_id", name(1).alias("call_id"), F.col("text").alias("content"), "turn")
    return calls, results

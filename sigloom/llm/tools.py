"""Tool calls in chats: link, order, validate, serialise.

Calls and results meet in a hash join on (conversation, call id).  A call may name the call it comes after; its level is
the number of calls before it on that chain, found by pointer doubling: in every round each call learns the ancestor
twice as far up, so a chain of n calls takes log2(n) joins and no conversation is gathered in one task.  Calls on a
circle have no level.  Arguments are checked against a JSON schema per tool name and written as canonical JSON.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.llm.common import pieces, written

KEYS = ["conv", "call_id"]
_TYPES = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool, "null": type(None)}


def canonical(value) -> str:
    """Keys sorted by code point, no blanks, characters as they are; whole floats as integers; no NaN or infinity."""
    def plain(v):
        if isinstance(v, float) and math.isfinite(v) and v == int(v) and abs(v) < 2 ** 53:
            return int(v)
        if isinstance(v, dict):
            return {k: plain(x) for k, x in v.items()}
        return [plain(x) for x in v] if isinstance(v, list) else v
    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """Violations of a JSON schema (type, enum, properties, required, additionalProperties, items, lengths and bounds)."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return [f"{at}: not of type {kind}"]
    out = [f"{at}: not one of the allowed values"] if "enum" in schema and value not in schema["enum"] else []
    if isinstance(value, dict):
        fields = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties") is False:
            out += [f"{at}.{k}: unknown" for k in value if k not in fields]
        for k in fields:
            if k in value:
                out += problems(value[k], fields[k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += problems(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, str):
        out += [f"{at}: too short"] if len(value) < schema.get("minLength", 0) else []
        out += [f"{at}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        out += [f"{at}: too small"] if value < schema.get("minimum", value) else []
        out += [f"{at}: too large"] if value > schema.get("maximum", value) else []
    return out


_CHECKED = {"type", "enum", "properties", "required", "additionalProperties", "items", "minLength", "maxLength", "minimum", "maximum"}
_NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "deprecated"}


def require_known(schema: dict, at: str = "$") -> None:
    """An error for a schema with a keyword that ``problems`` does not check, as it would let wrong arguments pass."""
    unknown = sorted(set(schema) - _CHECKED - _NOTES)
    if unknown:
        raise ValueError(f"{at}: schema keywords that are not checked: {', '.join(unknown)}")
    if schema.get("type", "null") not in list(_TYPES) or schema.get("additionalProperties", True) not in (True, False):
        raise ValueError(f"{at}: only a single type and a plain additionalProperties are checked")
    for k, field in schema.get("properties", {}).items():
        require_known(field, f"{at}.{k}")
    if "items" in schema:
        require_known(schema["items"], f"{at}[]")


def read_arguments(raw: str | None, schema: dict) -> tuple[object, list[str]]:
    """(arguments, violations); null and one violation for what is no JSON or has no canonical form.

    That are numbers beyond the range of doubles, half surrogate pairs and nesting beyond Python's stack.
    """
    def refuse(name: str):
        raise ValueError(name)

    try:
        value = json.loads(raw or "", parse_constant=refuse)
        found = problems(value, {"type": "object"} | schema)
        canonical(value).encode()
        "".join(found).encode()
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]
    return value, found


def levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level) from (conv, call_id, after): null for calls on a circle or behind one.

    A call after one that does not exist begins a chain of its own.
    """
    known = calls.select(F.col("conv").alias("kc"), F.col("call_id").alias("up"))
    state = written(calls.join(known, (F.col("after") == F.col("up")) & F.col("conv").eqNullSafe(F.col("kc")), "left")
                         .select("conv", "call_id", "up", F.when(F.col("up").isNull(), F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("level")), "chain0")
    longest = 1  # an ancestor that is still open lies this many steps up; no chain is longer than there are calls
    total = state.count()
    while longest <= total and not state.filter("up is not null").isEmpty():
        a, b = state.alias("a"), state.select("conv", F.col("call_id").alias("id"), F.col("up").alias("far"), F.col("level").alias("more")).alias("b")
        # The rows that are done do not join: their ``up`` is null.
        step = a.join(b, (F.col("a.up") == F.col("b.id")) & F.col("a.conv").eqNullSafe(F.col("b.conv")), "left")
        state = written(step.select("a.conv", "call_id", F.col("far").alias("up"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")), "chain")
        longest *= 2
    return state.select("conv", "call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: conv, call_id, turn, level, answered, valid, problems, canonical.

    ``calls``: conv, call_id, turn, name, arguments (JSON text), after; ``results``: conv, call_id, turn, content.
    Of calls (or results) that repeat an id in a conversation the first by turn counts, ties by the smaller content.
    Arguments that are null, no JSON or no object are not valid; a tool without a schema accepts any object.  A call
    without an id is dropped, as nothing can refer to it; a missing result is null in the canonical form.  Results that
    no call asked for are left out here: ``orphans`` gives them.  A schema with a keyword that is not checked is an error.
    """
    for name, schema in schemas.items():
        require_known(schema, name)
    first_call = (calls.filter("call_id is not null").groupBy(*KEYS)
                       .agg(F.min(F.struct("turn", "arguments", "name", "after")).alias("c")).select(*KEYS, "c.turn", "c.name", "c.arguments", "c.after"))
    first_call = written(first_call, "calls")
    first_result = (results.filter("call_id is not null").groupBy(*KEYS)
                           .agg(F.min(F.struct("turn", "content")).alias("r")).select(F.col("conv").alias("rc"), F.col("call_id").alias("ri"), "r.content"))
    level = levels(first_call).select(F.col("conv").alias("lc"), F.col("call_id").alias("li"), "level")
    joined = (first_call.join(first_result, F.col("conv").eqNullSafe(F.col("rc")) & (F.col("call_id") == F.col("ri")), "left")
                        .join(level, F.col("conv").eqNullSafe(F.col("lc")) & (F.col("call_id") == F.col("li")), "left"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "arguments"):
                cols = dict(zip(piece.schema.names, (c.to_pylist() for c in piece.columns)))
                found, texts = [], []
                for call_id, name, raw, content in zip(cols["call_id"], cols["name"], cols["arguments"], cols["content"]):
                    args, bad = read_arguments(raw, schemas.get(name, {}))
                    found.append(bad)
                    texts.append(canonical({"arguments": args, "id": call_id, "name": name, "result": content}))
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(piece.schema.get_field_index(c)) for c in ("conv", "call_id", "turn", "level")],
                     pa.array([c is not None for c in cols["content"]]), pa.array([not b for b in found]), pa.array(found, pa.list_(pa.string())), pa.array(texts)],
                    ["conv", "call_id", "turn", "level", "answered", "valid", "problems", "canonical"])

    kind = dict(calls.dtypes)["conv"]
    schema = f"conv {kind}, call_id string, turn bigint, level bigint, answered boolean, valid boolean, problems array<string>, canonical string"
    return joined.select("conv", "call_id", F.col("turn").cast("bigint").alias("turn"), "level", "name", "arguments", "content").mapInArrow(check, schema)


def orphans(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose (conv, call_id) no call has, or that name no call."""
    asked = calls.filter("call_id is not null").select(F.col("conv").alias("ac"), F.col("call_id").alias("ai")).distinct()
    return results.join(asked, F.col("conv").eqNullSafe(F.col("ac")) & (F.col("call_id") == F.col("ai")), "left_anti")


def transcripts(links: DataFrame) -> DataFrame:
    """(conv, position, canonical): the calls of each conversation in topological order, by level, then turn, then id.

    Positions are counted per conversation and level first, so that no window holds more than one level.
    """
    sizes = links.groupBy("conv", "level").agg(F.count(F.lit(1)).alias("n"))

    above = Window.partitionBy("conv").orderBy(F.col("level").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("conv").alias("sc"), F.col("level").alias("sl"), F.coalesce(F.sum("n").over(above), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv", "level").orderBy("turn", "call_id")
    joined = links.join(starts, F.col("conv").eqNullSafe(F.col("sc")) & F.col("level").eqNullSafe(F.col("sl")))
    return joined.select("conv", (F.col("start") + F.row_number().over(inside) - 1).alias("position"), "call_id", "level", "canonical")

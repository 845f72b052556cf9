"""Linking of tool calls and results in chats.

Calls and results meet in a hash join on (conversation, call id). A call may
name the call whose result it needs (``after``); levels in that forest, found by
pointer doubling, are a topological order: a call has level ``2 * depth``, its
result the next one. Sorting a conversation by (level, turn, call id) puts every
message after what it needs, without gathering a conversation in one task.
Arguments are parsed, held against the tool's schema (a subset of JSON schema:
type, required, properties, enum, minimum, maximum; unknown arguments are
errors) and written as canonical JSON: sorted keys, no spaces, shortest numbers.

Defined cases: a result without a call is an orphan, a call without a result is
open. Of several calls (results) with one id in a conversation the first by turn
counts, and the row tells how many there were; null turns come last. Rows with a
null conversation or id link with nothing and keep their own row. An ``after``
that names no call is an error and counts as none; calls on a cycle have no
level. Arguments that are no JSON object, or hold a number beyond the doubles, are
invalid and have no canonical form. Half surrogate pairs stay escapes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lowtide.sources.sinks import stage

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


def violations(arguments: object, schema: dict, path: str = "") -> list[str]:
    """What is wrong with parsed arguments, as sorted ``path: reason`` texts."""
    found = []
    kind = schema.get("type")
    if kind and (not isinstance(arguments, _TYPES[kind]) or (isinstance(arguments, bool) and kind in ("integer", "number"))):
        return [f"{path or '.'}: not {kind}"]
    if "enum" in schema and arguments not in schema["enum"]:
        found.append(f"{path}: not allowed")
    if isinstance(arguments, (int, float)) and not isinstance(arguments, bool):
        if "minimum" in schema and arguments < schema["minimum"] or "maximum" in schema and arguments > schema["maximum"]:
            found.append(f"{path}: out of range")
    if isinstance(arguments, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in arguments]
        for k, v in arguments.items():
            found += violations(v, known[k], f"{path}.{k}") if k in known else [f"{path}.{k}: unknown"]
    return sorted(found)


def _only_numbers(name: str) -> None:
    raise ValueError(f"{name} is no JSON number")


def _number(text: str) -> int | float:
    """A number with a fraction or exponent; whole ones below 10^21 are integers, so 1, 1.0 and 1e0 are one value."""
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise ValueError("beyond the largest double")
    return int(value) if value.is_integer() and abs(value) < 1e21 else value


def plain(text: str) -> str:
    """``text`` with half surrogate pairs written as escapes, since no UTF-8 text can hold them."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(text: str | None) -> tuple[object, str | None]:
    """Parsed value and canonical form; (None, None) if the text is no JSON or holds a number beyond the doubles.

    A repeated key keeps its last value.
    """
    try:
        value = json.loads(text or "", parse_constant=_only_numbers, parse_float=_number)
        return value, plain(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))
    except (ValueError, RecursionError):
        return None, None


def _first(rows: DataFrame, count: str, *columns: str) -> DataFrame:
    least = F.min(F.struct(F.col("turn").isNull().alias("late"), "turn", *columns)).alias("one")
    return rows.groupBy("conv_id", "call_id").agg(least, F.count(F.lit(1)).alias(count)).select(
        "conv_id", "call_id", "one.turn", *(f"one.{c}" for c in columns), count)


def levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth, missing``: steps to the first call of the chain; null depth on a cycle."""
    names = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    state = stage(calls.join(names, ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("known"), F.col("after")).alias("up"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth"),
        (F.col("after").isNotNull() & F.col("known").isNull()).alias("missing")), "levels")
    rounds, waiting = 0, state.filter("up is not null").count()
    while waiting and 1 << rounds <= 2 * waiting:
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        state = stage(state.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), "missing"), "levels")
        rounds, left = rounds + 1, state.filter("up is not null").count()
        if not left:
            break
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "missing")


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call and each orphan result.

    ``calls(conv_id, call_id, turn, name, arguments, after)``, ``results(conv_id, call_id, turn, content)``;
    ``schemas`` by tool name.
    """
    keyed = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = stage(_first(calls.filter(keyed), "n_calls", "name", "arguments", "after"), "calls")
    answers = _first(results.filter(keyed), "n_results", "content").withColumnsRenamed({"turn": "result_turn"})
    linked = first.withColumnsRenamed({"turn": "call_turn"}).join(answers, ["conv_id", "call_id"], "full").join(
        levels(first), ["conv_id", "call_id"], "left")
    loose = calls.filter(~keyed).select("conv_id", "call_id", F.col("turn").alias("call_turn"), "name", "arguments", F.lit(1).cast("long").alias("n_calls"),
                                        F.lit(0).cast("long").alias("depth")).unionByName(
        results.filter(~keyed).select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content", F.lit(1).cast("long").alias("n_results")),
        allowMissingColumns=True)
    rows = linked.drop("after").unionByName(loose, allowMissingColumns=True)
    status = F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "open").otherwise("linked")
    rows = rows.select("conv_id", "call_id", "name", status.alias("status"), (2 * F.col("depth")).alias("level"), "call_turn", "result_turn",
                       F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                       F.coalesce("missing", F.lit(False)).alias("missing"), "arguments", "content")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrong, texts = [], []
            for name, state, missing, arguments in zip(*(batch.column(c).to_pylist() for c in ("name", "status", "missing", "arguments"))):
                value, text = canonical(arguments)
                if state == "orphan":
                    wrong.append([])
                    texts.append(None)
                    continue
                problems = ["no such tool"] if name not in schemas else violations(value, {**schemas[name], "type": "object"})
                wrong.append(problems + ["no such dependency"] * bool(missing))
                texts.append(text if isinstance(value, dict) else None)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array([plain("; ".join(w)) for w in wrong], pa.string()), pa.array(texts, pa.string())],
                [*names, "errors", "canonical"])

    names = ["conv_id", "call_id", "name", "status", "level", "call_turn", "result_turn", "n_calls", "n_results", "content"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return rows.mapInArrow(run, f"{schema}, errors string, canonical string")

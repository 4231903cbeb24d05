"""Operator 8: tool-call linking.

Calls and results meet in a join on their identifier, calls are ordered by
what they wait for (a level per call), arguments are checked against the tools' schemas, and every call is written as canonical
JSON.  All output is a row per call or result, so that no conversation has to
fit in one task.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.session import work_dir

from .common import written

CALL_COLUMNS = ("conv_id", "turn", "call_id", "name", "arguments", "after")
RESULT_COLUMNS = ("conv_id", "turn", "call_id", "content")


def canonical_json(value: Any) -> str:
    """JSON with sorted keys, no spaces and one form per number; whole floats are written as integers.

    Keys are sorted by UTF-16 code units.  NaN and infinities have no form and raise ValueError.
    """
    if isinstance(value, Mapping):
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{canonical_json(k)}:{canonical_json(v)}" for k, v in items) + "}"
    if isinstance(value, list | tuple):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    if isinstance(value, float) and math.isfinite(value) and value.is_integer() and abs(value) < 1e21:
        value = int(value)
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and (kind == "number" or value.is_integer())
        return whole and not isinstance(value, bool)
    return isinstance(value, _TYPES[kind])


def schema_errors(value: Any, schema: Mapping[str, Any], at: str = "$") -> list[str]:
    """What is wrong with a value: types, required and unknown members, enum, lengths, bounds and items of a JSON schema."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{at}: not {' or '.join(kinds)}"]
    out = [] if "enum" not in schema or value in schema["enum"] else [f"{at}: not in enum"]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        if schema.get("additionalProperties", True) is False:
            out += [f"{at}.{k}: unknown" for k in sorted(value) if k not in known]
        for k in sorted(k for k in value if k in known):
            out += schema_errors(value[k], known[k], f"{at}.{k}")
    size = len(value) if isinstance(value, str | list) else None
    low, high = ("minItems", "maxItems") if isinstance(value, list) else ("minLength", "maxLength")
    if size is not None and size < schema.get(low, 0):
        out.append(f"{at}: too short")
    if size is not None and size > schema.get(high, size):
        out.append(f"{at}: too long")
    if _is(value, "number"):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += schema_errors(x, schema["items"], f"{at}[{i}]")
    return out


#: Waits of one conversation that are ordered inside a task; longer conversations are ordered by joins, to the same levels.
TASK_EDGES = 100_000


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Levels of the calls that wait for others, one conversation after the other (rows come sorted by conversation)."""
    kind = [pa.null()]

    def rows() -> Iterator[tuple[Any, str, str]]:
        for batch in batches:
            kind[0] = batch.schema.field("conv_id").type
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "call_id", "parent")), strict=True)

    done: list[tuple[Any, str, int]] = []

    def out(least: int) -> Iterator[pa.RecordBatch]:
        while len(done) >= least:
            part, done[:10_000] = done[:10_000], []
            yield pa.RecordBatch.from_pydict(dict(zip(("conv_id", "call_id", "level"), zip(*part, strict=True), strict=True)),
                                             schema=pa.schema([("conv_id", kind[0]), ("call_id", pa.string()), ("level", pa.int32())]))

    for conv, edges in itertools.groupby(rows(), key=lambda r: r[0]):
        done += [(conv, call, level) for call, level in _placed([(call, parent) for _, call, parent in edges])]
        yield from out(10_000)
    yield from out(1)


def _placed(edges: list[tuple[str, str]]) -> Iterator[tuple[str, int]]:
    """(call, level) of the calls of a conversation that wait for others: a call is placed when all it waits for are."""
    waits: dict[str, int] = {}
    followers: dict[str, list[str]] = {}
    for call, parent in edges:
        waits[call] = waits.get(call, 0) + 1
        followers.setdefault(parent, []).append(call)
    level = {key: 0 for key in followers if key not in waits}
    ready = list(level)
    while ready:
        key = ready.pop()
        for follower in followers.get(key, ()):
            waits[follower] -= 1
            level[follower] = max(level.get(follower, 0), level[key] + 1)
            if not waits[follower]:
                ready.append(follower)
                yield follower, level[follower]


def levels(nodes: DataFrame, edges: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """(conv_id, call_id, level): level 0 waits for nothing, level n for a call of level n-1 at most.

    ``edges`` has conv_id, call_id and parent, all among ``nodes``.  Calls in
    or behind a cycle have no row.  Conversations of up to ``task_edges``
    waits are ordered within tasks, many at a time; longer ones by peeling
    off, round by round and with joins, the edges whose parent is placed, in
    as many rounds as the longest chain has calls.
    """
    spark = nodes.sparkSession
    path = work_dir(spark, "levels")
    key = ["conv_id", "call_id"]
    left = written(edges.select(*key, "parent").distinct(), "edges")
    nodes.select(*key).join(left.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(0)).write.parquet(path)
    long = written(left.groupBy("conv_id").count().where(F.col("count") > task_edges).select("conv_id"), "long_conversations")
    schema = f"conv_id {left.schema['conv_id'].dataType.simpleString()}, call_id string, level int"
    whole = left.join(long, "conv_id", "left_anti").repartition("conv_id").sortWithinPartitions("conv_id")
    whole.mapInArrow(_order, schema).write.mode("append").parquet(path)
    left = written(left.join(long, "conv_id", "left_semi"), "edges")
    level = 0
    while not left.isEmpty():
        free = spark.read.parquet(path).where(F.col("level") == level).select("conv_id", F.col("call_id").alias("parent"))
        rest = written(left.join(free, ["conv_id", "parent"], "left_anti"), "edges")
        level += 1
        got = written(left.select(*key).distinct().join(rest.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(level)), "level")
        if got.isEmpty():
            break
        got.write.mode("append").parquet(path)
        left = rest
    return spark.read.parquet(path)


def _first(rows: DataFrame, rest: tuple[str, ...]) -> DataFrame:
    """Per identifier the smallest row by turn and contents (a partial aggregate), and how many different rows there were."""
    best = F.min(F.struct(*rest)).alias("first")
    return rows.distinct().groupBy("conv_id", "call_id").agg(best, F.count(F.lit(1)).alias("rows")).select("conv_id", "call_id", "first.*", "rows")


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """(conv_id, level, turn, call_id, status, errors, json): one row per call identifier, and per result without a call.

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON text) and after
    (identifiers of calls whose results it needs), ``results`` conv_id, turn,
    call_id and content; other columns are not read.  Within a conversation
    (level, turn, call_id) is a topological order.  Of rows that share an
    identifier the smallest by turn, then contents, is taken (nulls first);
    exact repeats count once, others are named in ``errors``.  Rows with a null
    conversation or identifier cannot be linked: such calls and results have
    the status "unidentified".  Parents that are not calls of the conversation
    are named in ``errors`` and not waited for.

    status: ok; no_result; invalid (arguments not JSON, not by the schema, or
    no such tool); cycle (level null); orphan_result; unidentified.
    """
    calls, results = calls.select(*CALL_COLUMNS), results.select(*RESULT_COLUMNS)
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = written(_first(calls.where(known).withColumn("after", F.array_sort(F.array_distinct(F.coalesce("after", F.array().cast("array<string>"))))),
                           ("turn", "name", "arguments", "after")), "calls")
    answers = written(_first(results.where(known), ("turn", "content")).select(
        "conv_id", "call_id", F.col("content"), F.col("turn").alias("result_turn"), F.col("rows").alias("result_rows"), F.lit(True).alias("answered")), "results")
    wanted = first.select("conv_id", "call_id", F.explode("after").alias("parent")).where("parent is not null")
    edges = written(wanted.join(first.select("conv_id", F.col("call_id").alias("parent")), ["conv_id", "parent"]), "call_edges")
    parents = edges.groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set("parent")).alias("parents"))
    linked = first.join(levels(first, edges), ["conv_id", "call_id"], "left").join(written(parents, "parents"), ["conv_id", "call_id"], "left").join(
        answers, ["conv_id", "call_id"], "left")
    orphans = answers.join(first, ["conv_id", "call_id"], "left_anti").select(
        "conv_id", F.lit(None).cast("int").alias("level"), F.col("result_turn").alias("turn"), "call_id", F.lit("orphan_result").alias("status"), "content")
    lost = calls.where(~known).distinct().select("conv_id", F.lit(None).cast("int").alias("level"), "turn", "call_id", F.lit("unidentified").alias("status"),
                                                 F.col("arguments").alias("content")).union(
        results.where(~known).distinct().select("conv_id", F.lit(None).cast("int"), "turn", "call_id", F.lit("unidentified"), "content"))
    schema = calls.schema
    kinds = {c: schema[c].dataType.simpleString() for c in ("conv_id", "turn", "call_id")}
    out_schema = f"conv_id {kinds['conv_id']}, level int, turn {kinds['turn']}, call_id {kinds['call_id']}, status string, errors string, json string"
    tools = {name: dict(s) for name, s in schemas.items()}

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            status, errors, texts = [], [], []
            for r in batch.to_pylist():
                faults = []
                try:
                    arguments = json.loads(r["arguments"]) if r["arguments"] is not None else None
                    canonical = canonical_json(arguments)
                    faults += schema_errors(arguments, tools[r["name"]]) if r["name"] in tools else ["no such tool"]
                except (ValueError, RecursionError):
                    canonical, faults = "null", ["not JSON"]
                bad = bool(faults)
                parents = r["parents"] or []
                faults += [f"no call {p}" for p in r["after"] if p is not None and p not in set(parents)]
                faults += ["repeated call"] * (r["rows"] > 1) + ["repeated result"] * ((r["result_rows"] or 0) > 1)
                status.append("cycle" if r["level"] is None else "invalid" if bad else "ok" if r["answered"] else "no_result")
                errors.append("; ".join(faults))
                texts.append(f'{{"after":{canonical_json(parents)},"arguments":{canonical},"call_id":{canonical_json(r["call_id"])},'
                             f'"name":{canonical_json(r["name"])},"result":{canonical_json(r["content"])}}}')
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "level", "turn", "call_id")), pa.array(status, pa.string()),
                                              pa.array(errors, pa.string()), pa.array(texts, pa.string())],
                                             ["conv_id", "level", "turn", "call_id", "status", "errors", "json"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [canonical_json({"call_id": i, "result": c}) for i, c in zip(batch.column("call_id").to_pylist(), batch.column("content").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "level", "turn", "call_id", "status")), pa.array([""] * len(texts), pa.string()),
                                              pa.array(texts, pa.string())], ["conv_id", "level", "turn", "call_id", "status", "errors", "json"])

    return linked.mapInArrow(serialise, out_schema).union(orphans.union(lost).mapInArrow(alone, out_schema))


# The tools that turns of a conversation are taken to call
TURN_TOOLS = {
    "answer": {"type": "object", "required": ["question", "turn"], "additionalProperties": False,
               "properties": {"question": {"type": "string", "minLength": 1, "maxLength": 300}, "turn": {"type": "integer", "minimum": 0}}},
    "configure": {"type": "object", "required": ["instructions"], "additionalProperties": False, "properties": {"instructions": {"type": "string", "minLength": 1}}},
}


def turn_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results: a system turn configures, a user turn asks, an assistant turn is the
    result of the turn before it, and a call waits for the one two turns before (the second turn's for the first's).

    Roles count in any case.  A turn of another or no role, or without a
    number or conversation, can be linked to nothing: it is a result without
    an identifier, which ``link_calls`` reports as unidentified.
    """
    conversations = conversations.select("conv_id", "turn", F.lower("role").alias("role"), "text")

    def name(back: int) -> Any:
        return F.md5(F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string")).cast("binary"))

    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    arguments = F.when(F.col("role") == "system", F.to_json(F.struct(F.col("text").alias("instructions")))).otherwise(
        F.to_json(F.struct(F.col("text").alias("question"), "turn")))
    after = F.when(F.col("turn") >= 2, F.array(name(2))).when(F.col("turn") == 1, F.array(name(1))).otherwise(F.array().cast("array<string>"))
    calls = conversations.where(known & F.col("role").isin("user", "system")).select(
        "conv_id", "turn", name(0).alias("call_id"), F.when(F.col("role") == "system", F.lit("configure")).otherwise(F.lit("answer")).alias("name"),
        arguments.alias("arguments"), after.alias("after"))
    linked = known & F.coalesce(F.col("role") == "assistant", F.lit(False))
    others = conversations.where(linked | ~known | ~F.coalesce(F.col("role").isin("user", "system", "assistant"), F.lit(False)))
    return calls, others.select("conv_id", "turn", F.when(linked, name(1)).alias("call_id"), F.col("text").alias("content"))

"""Chat formatting: tool calls linked with their results, in order, as canonical JSON.

Calls and results meet by a hash join on their identifier, both sides reduced to one row per
identifier before the shuffle. A call comes after the calls it depends on. Its arguments are
validated against the tool's schema, and call and result become one line of canonical JSON.
"""

import json
import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderloom.llm.text import parts, reachable
from orderloom.session import cut_lineage

ID = ["conversation", "call_id"]
_LAST = (1 << 63) - 1

#: The tools that `conversation_calls` derives, as JSON schemas of their arguments.
TURN_TOOLS = {
    "instruct": {"type": "object", "required": ["instruction", "turn"],
                 "additionalProperties": False,
                 "properties": {"instruction": {"type": "string", "minLength": 1},
                                "turn": {"type": "integer", "minimum": 0}}},
    "ask": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False,
            "properties": {"prompt": {"type": "string", "minLength": 1},
                           "turn": {"type": "integer", "minimum": 0}}},
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results) of plain conversations (conv_id, turn, role, text).

    A user's turn calls `ask`, a system's turn `instruct`; an assistant's turn is the result of
    the turn before it. The call before a call is two turns back, or one if it is the second
    turn. Of two such calls the longer one depends on the shorter one: a follow-up in fewer words
    (characters; a null text has none) says what the request before it is about. If they are
    equally long, or the call before is missing, the later one depends on the earlier. So calls
    depend on later as well as on earlier ones, never in a cycle. Turns of other roles are
    ignored; of repeated turns the shortest text counts here.
    """
    def name(turn):
        return F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"),
                        turn.cast("string"))

    turn, role = F.col("turn"), F.col("role")
    body = F.when(role == "system", F.to_json(F.struct(F.col("text").alias("instruction"), turn))
                  ).otherwise(F.to_json(F.struct(F.col("text").alias("prompt"), turn)))
    calling = turns.where(role.isin("user", "system"))
    sizes = calling.groupBy("conv_id", "turn").agg(
        F.min(F.coalesce(F.length("text"), F.lit(0))).alias("size"))
    before = F.when(turn == 1, 0).when(turn > 0, turn - 2)
    pairs = sizes.withColumn("before", before).where("before IS NOT NULL").join(
        sizes.select("conv_id", turn.alias("before"), F.col("size").alias("size_before")),
        ["conv_id", "before"], "left")
    waits = F.col("size") < F.col("size_before")
    needs = pairs.select(
        "conv_id", F.when(waits, F.col("before")).otherwise(turn).alias("turn"),
        name(F.when(waits, turn).otherwise(F.col("before"))).alias("needs")).groupBy(
        "conv_id", "turn").agg(F.sort_array(F.collect_set("needs")).alias("depends_on"))
    calls = calling.join(needs, ["conv_id", "turn"], "left").select(
        F.col("conv_id").cast("string").alias("conversation"), name(turn).alias("call_id"),
        turn.cast("long").alias("place"),
        F.when(role == "system", "instruct").otherwise("ask").alias("name"),
        body.alias("arguments"),
        F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"))
    results = turns.where(role == "assistant").select(
        F.col("conv_id").cast("string").alias("conversation"), name(turn - 1).alias("call_id"),
        turn.cast("long").alias("place"), F.col("text").alias("content"))
    return calls, results


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Every call with its result, and every result without a call.

    `calls` has conversation, call_id, place, name, arguments, depends_on, and `results` has
    conversation, call_id, place, content; other columns are ignored. The result adds row (a
    number of its own for each row), content, answers (number of results) and status: linked,
    unanswered, repeated_id (an earlier call has the identifier, and gets the result), no_id
    (identifier or conversation is null), or orphan_result. Of several results the one with the
    smallest place counts, and of equal ones the smallest text. A null place comes last.
    """
    place = F.coalesce("place", F.lit(_LAST)).alias("place")
    calls = cut_lineage(
        calls.select(*ID, place, "name", "arguments", "depends_on")
        .withColumn("row", F.monotonically_increasing_id()), "chat-calls")
    named = F.col("conversation").isNotNull() & F.col("call_id").isNotNull()
    first = (calls.where(named).groupBy(*ID)
             .agg(F.min(F.struct("place", "row")).alias("first"))
             .select(*ID, F.col("first.row").alias("row")))
    answered = (results.where(named).select(*ID, place, "content").groupBy(*ID)
                .agg(F.min(F.struct("place", "content")).alias("answer"),
                     F.count("*").alias("answers"))
                .select(*ID, F.col("answer.place").alias("answer_place"),
                        F.col("answer.content").alias("content"), "answers"))
    met = cut_lineage(first.join(answered, ID, "full_outer"), "chat-links")
    of_calls = calls.join(
        met.where("row IS NOT NULL").select("row", "content", "answers", F.lit(1).alias("own")),
        "row", "left").withColumn(
        "status", F.when(~named, "no_id").when(F.col("own").isNull(), "repeated_id")
        .when(F.col("answers").isNull(), "unanswered").otherwise("linked")).drop("own")
    orphans = met.where("row IS NULL").select(
        *ID, F.col("answer_place").alias("place"), "content", "answers",
        F.lit("orphan_result").alias("status"))
    unnamed = results.where(~named).select(
        *ID, place, "content", F.lit(1).cast("long").alias("answers"),
        F.lit("orphan_result").alias("status"))
    return cut_lineage(
        of_calls.unionByName(orphans.unionByName(unnamed), allowMissingColumns=True)
        .drop("row").withColumn("row", F.monotonically_increasing_id()), "chat")


def order(linked: DataFrame) -> DataFrame:
    """`linked` with unknown_needs (dependencies on no known call), cyclic, and the columns
    order_at and order_step: sorting a conversation by them, then by place and call_id, puts
    each call after all it depends on.

    A call is due at its own place, or if it needs a call that is due there or later, a step
    after that one. Where calls only need earlier ones, as in a transcript, one join finds that
    out. Otherwise delays are handed on, a round for each step of the longest chain of delayed
    calls. More steps in a conversation than it has delayed calls mean a cycle: its calls, and
    those that need them, are marked and stay at their own place.
    """
    nodes = linked.where(F.col("status").isin("linked", "unanswered"))
    needs = nodes.select(*ID, "place", F.explode(F.array_distinct("depends_on")).alias("needs"))
    target = nodes.select("conversation", F.col("call_id").alias("needs"),
                          F.col("place").alias("needs_place"))
    edges = cut_lineage(needs.join(target, ["conversation", "needs"], "left"), "chat-edges")
    unknown = edges.where("needs_place IS NULL").groupBy(*ID).agg(
        F.count("*").alias("unknown_needs"))
    edges = edges.where("needs_place IS NOT NULL")
    state = nodes.select(*ID, "place", F.col("place").alias("order_at"),
                         F.lit(0).alias("order_step"), F.lit(False).alias("cyclic"))
    if edges.where("needs_place >= place").isEmpty():
        delays = state.where("false")
    else:
        delays = _delays(state, edges.select(*ID, "needs"))
    delays = delays.drop("place")
    return (linked.join(unknown, ID, "left").join(delays, ID, "left")
            .withColumns({
                "unknown_needs": F.coalesce("unknown_needs", F.lit(0)),
                "cyclic": F.coalesce("cyclic", F.lit(False)),
                "order_at": F.coalesce("order_at", "place"),
                "order_step": F.coalesce("order_step", F.lit(0))}))


def _delays(state: DataFrame, edges: DataFrame) -> DataFrame:
    """The calls that are delayed or cyclic, with their due places."""
    own = F.struct(F.col("place").alias("order_at"), F.lit(0).alias("order_step"))
    while True:
        needed = state.select("conversation", F.col("call_id").alias("needs"), "cyclic",
                              F.struct("order_at", (F.col("order_step") + 1).alias("order_step"))
                              .alias("after"))
        pushed = edges.join(needed, ["conversation", "needs"]).groupBy(*ID).agg(
            F.max(F.when(~F.col("cyclic"), F.col("after"))).alias("after"),
            F.max("cyclic").alias("behind"))
        moved = cut_lineage(
            state.join(pushed, ID, "left").select(
                *ID, "place", (F.col("cyclic") | F.coalesce("behind", F.lit(False)))
                .alias("cyclic"),
                F.struct("order_at", "order_step", "cyclic").alias("was"),
                F.greatest(own, F.coalesce("after", own)).alias("due")),
            "chat-order")
        limit = moved.groupBy("conversation").agg(
            F.count_if(F.col("due.order_step") > 0).alias("delayed"))
        state = cut_lineage(
            moved.join(limit, "conversation").select(
                *ID, "place", "was", F.when(F.col("cyclic"), F.col("place")).otherwise(
                    F.col("due.order_at")).alias("order_at"),
                F.when(F.col("cyclic"), 0).otherwise(F.col("due.order_step"))
                .alias("order_step"),
                (F.col("cyclic") | (F.col("due.order_step") > F.col("delayed"))).alias("cyclic")),
            "chat-order")
        moving = state.where("struct(order_at, order_step, cyclic) != was")
        state = state.drop("was")
        if moving.isEmpty():
            return state.where("cyclic OR order_step > 0")


def number(ordered: DataFrame) -> DataFrame:
    """`ordered` with position: the place of each row in its conversation, from 0.

    The rows are sorted over all tasks, so that a conversation of any length is spread; a row's
    position is the number of its conversation's rows in earlier tasks plus that in its own.
    """
    keys = ["conversation", "order_at", "order_step", "place", "call_id", "status"]
    dealt = cut_lineage(ordered.repartitionByRange(*keys)
                        .withColumn("task", F.spark_partition_id()), "chat-sorted")
    held = dealt.groupBy("conversation", "task").agg(F.count("*").alias("held"))
    before = Window.partitionBy("conversation").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = held.select(F.col("conversation").alias("of"), F.col("task").alias("in_task"),
                         F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conversation", "task").orderBy(*keys[1:])
    numbered = dealt.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(starts, F.col("conversation").eqNullSafe(F.col("of"))
                         & (F.col("task") == F.col("in_task"))).withColumn(
        "position", F.col("start") + F.col("inside")).drop(
        "of", "in_task", "start", "inside", "task")


_TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def faults(value, schema: dict, path="arguments") -> list[str]:
    """What is wrong with a JSON value: type, enum, minimum, maximum, minLength, required,
    properties, additionalProperties and items of JSON schema are checked."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    fits = {"integer": number and float(value).is_integer(), "number": number}.get(
        kind, kind is None or isinstance(value, _TYPES.get(kind, object)))
    if not fits:
        return [f"{path}: not of type {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{path}: not an allowed value")
    if number and value < schema.get("minimum", -math.inf):
        found.append(f"{path}: too small")
    if number and value > schema.get("maximum", math.inf):
        found.append(f"{path}: too large")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{path}: too short")
    if isinstance(value, list) and "items" in schema:
        for i, item in enumerate(value):
            found += faults(item, schema["items"], f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for key in sorted(value):
            if key in known:
                found += faults(value[key], known[key], f"{path}.{key}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{path}.{key}: unknown")
    return found


def canonical(value) -> str:
    """JSON with sorted keys, no spaces, and characters as they are."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False,
                      allow_nan=False)


def _object(pairs):
    if len({k for k, _ in pairs}) < len(pairs):
        raise ValueError("a key occurs twice")
    return dict(pairs)


def _constant(name):
    raise ValueError(f"{name} is no JSON")


def _loaded(text):
    return json.loads(text, object_pairs_hook=_object, parse_constant=_constant)


def serialise(call_id, name, arguments, content, status, tools) -> tuple[str, list[str]]:
    """Canonical JSON of a call with its result, and what is wrong with it. Arguments that are
    no JSON stand in it as the text they are."""
    message = {"id": call_id, "result": content}
    if status == "orphan_result":
        return canonical(message), ["no call has this identifier"]
    found = []
    try:
        value = _loaded(arguments or "")
        if name not in tools:
            found.append(f"unknown tool {name}")
        else:
            found += faults(value, tools[name])
    except (ValueError, RecursionError):
        value = arguments
        found.append("arguments: no JSON")
    return canonical(message | {"arguments": value, "name": name}), found


def format_calls(calls: DataFrame, results: DataFrame, tools: dict) -> DataFrame:
    """One row per call, and per result without a call: conversation, position (place in the
    conversation after ordering), call_id, status, answers, unknown_needs, cyclic, valid (no
    errors), errors (array) and message (canonical JSON).

    See `link` for null identifiers, repeated rows and ties, `order` for cycles. Empty tables
    give no rows. Rows without conversation are numbered together.
    """
    linked = link(calls, results)
    # order and numbers are found without the texts, which move once more to meet them
    numbered = number(order(linked.select("row", *ID, "place", "status", "depends_on")))
    rows = linked.join(numbered.select("row", "position", "unknown_needs", "cyclic"), "row").select(
        "conversation", "position", "call_id", "status", F.coalesce("answers", F.lit(0))
        .alias("answers"), "unknown_needs", "cyclic", "name", "content", "arguments")
    reachable(rows.sparkSession)
    kept = rows.columns[:7]
    schema = rows.select(*kept, F.lit(True).alias("valid"),
                         F.array(F.lit("")).alias("errors"), F.lit("").alias("message")).schema

    def run(batches):
        for batch in batches:
            for part in parts(batch, "arguments"):
                made = [serialise(*row, tools) for row in zip(
                    *(part.column(c).to_pylist() for c in (
                        "call_id", "name", "arguments", "content", "status")), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept),
                     pa.array([not errors for _, errors in made], pa.bool_()),
                     pa.array([errors for _, errors in made], pa.list_(pa.string())),
                     pa.array([m for m, _ in made], pa.string())],
                    names=[*kept, "valid", "errors", "message"])

    return rows.mapInArrow(run, schema)

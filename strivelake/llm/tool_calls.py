"""Operator 8: chat formatting - tool calls linked to their results.

Calls and results are hash-joined on (conversation, call identifier). A call may continue
another one (``parent_id``); the depth in that forest gives a topological order: a call comes
behind its parent's result, a result right behind its call. Depths are found by pointer
doubling (each round joins every call with the call it points to and adds the distances), so
a chain of n calls needs log2(n) rounds and no conversation is ever gathered in one task.
Arguments are parsed as variants, exploded to one row per argument and hash-joined with the
tool schemas (tool, param, type, required); each event is serialised as canonical JSON: keys
sorted, no white space, arguments normalised the same way.

DataFrame functions only; no window or list over a conversation, which may hold a third of
all rows. Events are ordered by (conv_id, level, turn), with level = 2 * depth (+ 1 for
results) as a column instead of a global rank.

``chat_events`` adds every turn as a message with its role and text, so system turns, first
prompts and other roles stay; messages are ordered by turn.

Defined results: of calls or results that repeat an identifier the first (smallest turn, then
text) is linked, those that differ from it in more than the turn follow with status
``duplicate``, level null; a result without a call is an ``orphan`` at level 1; a parent that does not exist
makes the call a root with error ``unknown parent``; calls in or behind a cycle have level
null and error ``cycle``; arguments that are null, empty, not JSON or not an object have
error ``arguments``; an unknown tool has error ``unknown tool``; rows without conversation or
identifier are linked with nothing and dropped from calls and results alike, as they cannot
be named; extra columns are ignored; empty tables give an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strivelake.llm.common import stage

KEY = ["conv_id", "call_id"]
ROLES = ["system", "user", "assistant", "tool"]


def json_type(variant: Column) -> Column:
    """JSON type of a variant: string, integer, number, boolean, null, object or array."""
    kind = F.schema_of_variant(variant)
    return (F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
            .when(kind == "BIGINT", "integer").when(kind == "VOID", "null")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
            .otherwise("number"))


def canonical(text: Column) -> Column:
    """Canonical JSON of a JSON text (null where it does not parse)."""
    return F.to_json(F.try_parse_json(text))


def _once(rows: DataFrame, values: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The first row per identifier (smallest turn, then ``values``) and the further rows that
    differ from it in ``values``, each once."""
    known = rows.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    variants = stage(known.groupBy(*KEY, *values).agg(F.min("turn").alias("turn")), name)
    whole = F.struct("turn", *values)
    first = stage(variants.groupBy(*KEY).agg(F.min(whole).alias("_v")), name)
    more = variants.join(first, KEY).filter(~whole.eqNullSafe(F.col("_v"))).drop("_v")
    return first.select(*KEY, "_v.*"), more


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, parent_known): depth null in or behind a cycle."""
    ids = calls.select(F.col("conv_id"), F.col("call_id").alias("parent_id"), F.lit(True).alias("known"))
    state = stage(calls.join(ids, ["conv_id", "parent_id"], "left").select(
        *KEY, F.when(F.col("known"), F.col("parent_id")).alias("points"),
        F.when(F.col("known"), 1).otherwise(0).alias("depth"),
        (F.col("parent_id").isNull() | F.col("known").isNotNull()).alias("parent_known")), "call-depth")
    left = state.filter(F.col("points").isNotNull()).count()
    while left:
        ahead = state.select("conv_id", F.col("call_id").alias("points"),
                             F.col("points").alias("next"), F.col("depth").alias("more"))
        state = stage(state.join(ahead, ["conv_id", "points"], "left").select(
            *KEY, F.col("next").alias("points"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), "parent_known"), "call-depth")
        still = state.filter(F.col("points").isNotNull()).count()
        if still == left:  # doubling settles some call in every round unless only cycles are left
            break
        left = still
    return state.select(*KEY, F.when(F.col("points").isNull(), F.col("depth")).alias("depth"), "parent_known")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, errors): what the schemas object to, sorted; only calls with errors."""
    spark = calls.sparkSession
    parsed = calls.select(*KEY, "name", F.try_parse_json("arguments").alias("v"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    broken = parsed.filter(~is_object).select(*KEY, F.lit("arguments").alias("error"))
    given = (parsed.filter(is_object)
             .lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
             .select(*KEY, "name", F.col("key").alias("param"), json_type(F.col("value")).alias("type")))
    tools = schemas.select(F.col("tool").alias("name")).distinct()
    unknown = (calls.select(*KEY, "name").join(tools, "name", "left_anti")
               .select(*KEY, F.lit("unknown tool").alias("error")))
    declared = schemas.select(F.col("tool").alias("name"), "param", F.col("type").alias("want"), "required")
    checked = given.join(tools, "name", "left_semi").join(declared, ["name", "param"], "left")
    wrong = (checked.filter("want is null").select(*KEY, F.concat(F.lit("unexpected "), "param").alias("error"))
             .union(checked.filter((F.col("type") != F.col("want"))
                                   & ~((F.col("want") == "number") & (F.col("type") == "integer")))
                    .select(*KEY, F.concat(F.lit("type of "), "param").alias("error"))))
    needs = parsed.filter(is_object).select(*KEY, "name").join(
        declared.filter("required").select("name", "param"), "name")
    missing = (needs.join(given.select(*KEY, "param"), [*KEY, "param"], "left_anti")
               .select(*KEY, F.concat(F.lit("missing "), "param").alias("error")))
    return (broken.union(unknown).union(wrong).union(missing)
            .groupBy(*KEY).agg(F.array_sort(F.collect_set("error")).alias("errors")))


def _call_json() -> Column:
    # to_json leaves null fields out; struct fields are named in sorted order
    return canonical(F.to_json(F.struct(
        F.coalesce(canonical(F.col("arguments")), F.lit("null")).alias("arguments"),
        F.col("call_id").alias("id"), F.col("name").alias("name"), F.col("parent_id").alias("parent"),
        F.lit("call").alias("type"))))


def _result_json() -> Column:
    return canonical(F.to_json(F.struct(F.col("content").alias("content"), F.col("call_id").alias("id"),
                                        F.lit("result").alias("type"))))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per event: conv_id, call_id, kind (call, result), level, turn, status, valid,
    errors and json.

    ``calls``: conv_id, turn, call_id, parent_id, name, arguments (JSON text);
    ``results``: conv_id, turn, call_id, content.
    """
    calls, more_calls = _once(calls, ["name", "arguments", "parent_id"], "calls")
    results, more_results = _once(results, ["content"], "results")
    order = depths(calls)
    known = calls.join(order, KEY).join(argument_errors(calls, schemas), KEY, "left")
    errors = F.array_compact(F.concat(
        F.coalesce("errors", F.array().cast("array<string>")),
        F.array(F.when(~F.col("parent_known"), F.lit("unknown parent")),
                F.when(F.col("depth").isNull(), F.lit("cycle")))))
    both = (known.select(*KEY, F.col("turn").alias("call_turn"), "name", "arguments", "parent_id",
                         "depth", errors.alias("errors"))
            .join(results.withColumnRenamed("turn", "result_turn")
                  .withColumn("has_result", F.lit(True)), KEY, "full_outer"))
    has_call, has_result = F.col("call_turn").isNotNull() | F.col("errors").isNotNull(), F.col("has_result")
    status = (F.when(~has_call, "orphan").when(has_result.isNull(), "unanswered").otherwise("linked"))
    no_errors = F.coalesce("errors", F.array().cast("array<string>"))
    call = F.struct(
        F.lit("call").alias("kind"), (2 * F.col("depth")).alias("level"), F.col("call_turn").alias("turn"),
        _call_json().alias("json"))
    result = F.struct(
        F.lit("result").alias("kind"),
        F.when(~has_call, 1).otherwise(2 * F.col("depth") + 1).alias("level"),
        F.col("result_turn").alias("turn"), _result_json().alias("json"))
    events = F.array_compact(F.array(F.when(has_call, call), F.when(has_result, result)))
    linked = (both.select(*KEY, status.alias("status"), no_errors.alias("errors"),
                          F.explode(events).alias("e"))
              .select(*KEY, "e.kind", "e.level", "e.turn", "status",
                      ((F.size("errors") == 0) & (F.col("status") != "orphan")).alias("valid"),
                      "errors", "e.json"))

    def again(more: DataFrame, kind: str, json: Column) -> DataFrame:
        return more.select(
            *KEY, F.lit(kind).alias("kind"), F.lit(None).cast("int").alias("level"), "turn",
            F.lit("duplicate").alias("status"), F.lit(False).alias("valid"),
            F.array(F.lit("duplicate")).alias("errors"), json.alias("json"))

    return (linked.unionByName(again(more_calls, "call", _call_json()))
            .unionByName(again(more_results, "result", _result_json())))


def message_events(turns: DataFrame) -> DataFrame:
    """Every turn as an event of kind message, in the columns of ``link_calls`` (call_id and
    level null): the role and the text are in json; a role outside ``ROLES`` has error ``role``."""
    errors = F.array_compact(F.array(F.when(~F.coalesce(F.col("role").isin(ROLES), F.lit(False)), F.lit("role"))))
    return turns.select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), F.lit("message").alias("kind"),
        F.lit(None).cast("int").alias("level"), "turn", F.lit("message").alias("status"),
        (F.size(errors) == 0).alias("valid"), errors.alias("errors"),
        canonical(F.to_json(F.struct(F.col("text").alias("content"), F.col("role").alias("role"),
                                     F.lit("message").alias("type")))).alias("json"))


# Within a turn the message stands first, then its call, then its result.
KINDS = ["message", "call", "result"]


def chat_events(turns: DataFrame, schemas: DataFrame) -> DataFrame:
    """All of the table: every turn as a message, with the calls and results in the turns.

    ``place`` orders the events of a conversation (null for a turn without a number): 3 * turn
    plus the kind's place in ``KINDS``. A call stands in the turn that makes it and its result
    in a later one, so calls come before their results and parents before their children.
    """
    calls, results = calls_of_turns(turns)
    events = link_calls(calls, results, schemas).unionByName(message_events(turns))
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1
    return events.withColumn("place", (3 * F.col("turn") + kind).cast("long"))


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of ``conversations`` stand for: every assistant turn
    calls a tool with its whole text, the user turn behind it is the result."""
    size = F.length(F.coalesce("text", F.lit("")))
    name = F.element_at(F.array(*[F.lit(t) for t in TOOLS]), (size % len(TOOLS) + 1).cast("int"))
    at = F.col("turn")

    def ident(turn: Column) -> Column:
        return F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), turn.cast("string"))

    arguments = F.to_json(F.struct(
        F.when(size % 13 != 0, F.col("text")).alias("query"),
        F.when(size % 11 != 0, size).alias("limit"),
        F.when(size % 17 == 0, F.lit("x")).alias("extra"),
        F.when(size % 5 == 0, F.array(size, size + 1)).alias("between"),
        F.when(size % 7 == 0, F.struct(F.lit(True).alias("strict"), (size / 2).alias("share"))).alias("filter")))
    calls = turns.filter("role = 'assistant'").select(
        "conv_id", "turn", ident(at).alias("call_id"),
        F.when((at >= 2) & (size % 3 != 0), ident(at - 2)).alias("parent_id"),
        name.alias("name"), arguments.alias("arguments"))
    results = turns.filter("role = 'user' and turn > 0").select(
        "conv_id", "turn", ident(at - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


TOOLS = ["search", "lookup", "rank", "archive"]
# Schemas of the tools; ``archive`` has none.
SCHEMAS = [
    ("search", "query", "string", True), ("search", "limit", "integer", True),
    ("search", "between", "array", False), ("search", "filter", "object", False),
    ("lookup", "query", "string", True), ("lookup", "limit", "number", False),
    ("lookup", "between", "array", False), ("lookup", "filter", "object", False),
    ("rank", "query", "string", False), ("rank", "limit", "string", False),
    ("rank", "between", "array", False), ("rank", "extra", "string", False),
]


def schema_table(spark) -> DataFrame:
    return spark.createDataFrame(SCHEMAS, "tool string, param string, type string, required boolean")

"""Chat formatting: tool calls linked to their results, ordered, validated and written as canonical JSON.

All of it is DataFrame functions. A call has an identifier, a tool's name, its arguments as JSON text and the
identifiers of calls it needs (`after`); a result has the identifier of its call. Calls and results are joined
by (conversation, identifier) by hash; what has no partner is kept with a status of its own. Calls are layered
topologically: a call's layer is one more than the highest layer of the calls it needs. Arguments are parsed
as variants, whose text form has sorted keys and no blanks, and compared with the tool's schema.

Status of a call: `linked`, `pending` (no result). Of a result: `linked`, `orphan` (no call). If several rows
have one identifier, the first turn is the call or the result (of equal turns the smallest content) and the
others are `repeated`. A missing conversation is a conversation like any other. Arguments are
`valid`, `malformed` (no JSON object, or a key twice), `unknown_tool`, `missing` (a required one) or `mistyped`
(a type differs, or a name isn't in the schema). Calls that need each other in a circle, and calls that need
them, have layer null. Null arguments are an empty object; a missing identifier links with nothing. Empty
tables give no rows; further columns are not read, whatever their names. Texts of any length are kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway.session import to_scratch_table

#: JSON types and the variant types that stand for them.
TYPES = {
    "string": ["STRING"],
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DECIMAL", "DOUBLE", "FLOAT"],
    "boolean": ["BOOLEAN"],
    "object": ["OBJECT"],
    "array": ["ARRAY"],
    "null": ["VOID"],
}


def canonical(json: Column) -> Column:
    """The JSON text with sorted keys and no blanks; null if it can't be parsed."""
    return F.to_json(F.try_parse_json(json))


def argument_types(arguments: Column) -> Column:
    """map<string, string>: the leading type name of each argument of a JSON object."""
    kinds = F.transform_values(F.from_json(arguments, "map<string,variant>"), lambda _, v: F.schema_of_variant(v))
    return F.transform_values(kinds, lambda _, kind: F.regexp_extract(kind, "^[A-Z]+", 0))


def validated(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """Add `arguments_json` (canonical) and `validity`. `tools`: name, required array<string>, properties map<string, string>."""
    known = tools.select(F.col("name").alias("_tool"), F.col("required").alias("_required"), F.col("properties").alias("_properties"), F.lit(True).alias("_known"))
    given = F.coalesce("arguments", F.lit("{}"))
    joined = calls.withColumn("_json", canonical(given)).join(known, F.col("name") == F.col("_tool"), "left")
    joined = joined.withColumn("_types", F.when(F.col("_json").startswith("{"), argument_types(F.col("_json"))))
    kinds = F.map_from_arrays(F.array(*map(F.lit, TYPES)), F.array(*[F.array(*map(F.lit, v)) for v in TYPES.values()]))
    fits = F.forall(
        F.map_entries("_types"),
        lambda e: F.coalesce(F.array_contains(F.element_at(kinds, F.element_at(F.col("_properties"), e["key"])), e["value"]), F.lit(False)),
    )
    complete = F.forall("_required", lambda name: F.map_contains_key("_types", name))
    validity = (
        F.when(F.col("_types").isNull(), "malformed")
        .when(F.col("_known").isNull(), "unknown_tool")
        .when(~complete, "missing")
        .when(~fits, "mistyped")
        .otherwise("valid")
    )
    return joined.select(*[F.col(c) for c in calls.columns], F.col("_json").alias("arguments_json"), validity.alias("validity"))


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per call and per result: conv_id, turn, kind, id, status, name, arguments, after, content, anchor, step.

    `anchor` and `step` order a conversation: a result follows its call at once; orphans stay at their turn.
    """
    columns = ["conv_id", "turn", "kind", "id", "name", "arguments", "after", "content"]
    shaped = calls.select("conv_id", "turn", F.lit("call").alias("kind"), "id", "name", "arguments", "after", F.lit(None).cast("string").alias("content"))
    replies = results.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("array<string>").alias("after"), "content",
    )
    rows = to_scratch_table(shaped.unionByName(replies).withColumn("_row", F.monotonically_increasing_id()), "messages")
    # Partial minima before the shuffle: one row per identifier meets, however often it occurs.
    place = F.struct("turn", "name", "arguments", F.to_json("after").alias("after"), "content", "_row")
    first_of = lambda kind: F.min(F.when(F.col("kind") == kind, place))
    ends = rows.where(F.col("id").isNotNull()).groupBy("conv_id", "id").agg(first_of("call").alias("call"), first_of("result").alias("result"))
    ends = ends.select(
        F.col("conv_id").alias("_conv"), F.col("id").alias("_id"), F.col("call._row").alias("call_row"), F.col("result._row").alias("result_row"),
        F.col("call.turn").alias("call_turn"),
    )
    joined = rows.join(ends.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("id") == F.col("_id")), "left")
    own = F.when(F.col("kind") == "call", F.col("call_row")).otherwise(F.col("result_row"))
    other = F.when(F.col("kind") == "call", F.col("result_row")).otherwise(F.col("call_row"))
    status = (
        F.when(own != F.col("_row"), "repeated")
        .when(other.isNotNull(), "linked")
        .when(F.col("kind") == "call", "pending")
        .otherwise("orphan")
    )
    follows = (F.col("kind") == "result") & F.col("call_row").isNotNull()
    return joined.select(
        *columns,
        status.alias("status"),
        F.when(follows, F.col("call_turn")).otherwise(F.col("turn")).alias("anchor"),
        follows.cast("int").alias("step"),
    )


def layered(calls: DataFrame) -> DataFrame:
    """(conv_id, id, layer) of identified calls, by rounds over the calls whose needs are settled.

    Needs that name no call of the conversation count as settled. A round is one join per layer of the graph.
    A conversation is joined as a struct, so that a missing one meets itself.
    """
    calls = calls.withColumn("conv_id", F.struct(F.col("conv_id").alias("v")))
    nodes = calls.where(F.col("id").isNotNull()).groupBy("conv_id", "id").agg(F.flatten(F.collect_set(F.coalesce("after", F.array().cast("array<string>")))).alias("after"))
    edges = nodes.select("conv_id", "id", F.explode("after").alias("need")).distinct()
    names = nodes.select("conv_id", F.col("id").alias("need"))
    edges = to_scratch_table(edges.join(names, ["conv_id", "need"], "left_semi"), "needs")
    waits = edges.select("conv_id", "id").distinct()
    settled = to_scratch_table(nodes.select("conv_id", "id").join(waits, ["conv_id", "id"], "left_anti").withColumn("layer", F.lit(0)), "layers")
    while not edges.isEmpty():
        done = settled.select("conv_id", F.col("id").alias("need"), F.col("layer").alias("need_layer"))
        state = edges.join(done, ["conv_id", "need"], "left")
        ready = state.groupBy("conv_id", "id").agg(F.count(F.lit(1)).alias("n"), F.count("need_layer").alias("k"), (F.max("need_layer") + 1).alias("layer"))
        ready = to_scratch_table(ready.where("n = k").select("conv_id", "id", "layer"), "layers")
        if ready.isEmpty():
            break
        settled = settled.unionByName(ready)
        edges = to_scratch_table(edges.join(ready, ["conv_id", "id"], "left_anti"), "needs")
    return settled.withColumn("conv_id", F.col("conv_id.v"))


def formatted(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """Every call and result with its status, validity, place (layer, anchor, step, turn) and canonical JSON."""
    rows = linked(calls, results)
    asked = validated(rows.where(F.col("kind") == "call"), tools)
    layers = layered(calls).select(F.col("conv_id").alias("_conv"), F.col("id").alias("_id"), "layer")
    asked = asked.join(layers, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("id") == F.col("_id")), "left").drop("_conv", "_id")
    plain = rows.where(F.col("kind") == "result")
    both = asked.unionByName(plain, allowMissingColumns=True)
    quoted = lambda c: F.coalesce(F.substring(F.to_json(F.struct(F.col(c).alias("v"))), 6, 1 << 30), F.lit("null}"))
    value = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(F.regexp_replace(quoted(c), r"\}$", ""))
    call = F.concat(F.lit('{"arguments":'), F.coalesce("arguments_json", F.lit("null")), F.lit(',"id":'), value("id"), F.lit(',"name":'), value("name"), F.lit("}"))
    result = F.concat(F.lit('{"content":'), value("content"), F.lit(',"role":"tool","tool_call_id":'), value("id"), F.lit("}"))
    return both.select(
        "conv_id", "turn", "kind", "id", "status", "validity", "layer", "anchor", "step",
        F.when(F.col("kind") == "call", call).otherwise(result).alias("json"),
    )


def from_conversations(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read off plain conversations, which hold no tool calls themselves.

    User and system turns are calls, other turns are results; a turn without a role is neither. With n the
    number of code points of a turn's text (missing: none), c<n mod 7> is the identifier of its call (missing
    where 11 divides n) or the one its result answers; a call needs c<n div 7 mod 7> unless 3 divides n. The tool
    is picked by n mod 5, the form of the arguments by n div 5 mod 6: text and turn, the turn alone, a number for
    the text, the bare text (no JSON), none, or a name too many. So identifiers come back, results have no call,
    needs run over several turns or in a circle, and arguments break their schemas, all by the texts.
    """
    text = F.coalesce("text", F.lit(""))
    row = messages.select("conv_id", "turn", "role", F.col("text").alias("content"), text.alias("text"), F.length(text).cast("long").alias("n"))
    n = F.col("n")
    named = lambda k: F.concat(F.lit("c"), (k % 7).cast("string"))
    json = lambda *fields: F.to_json(F.struct(*fields))
    form = F.floor(n / 5) % 6
    arguments = (
        F.when(form == 0, json("turn", "text"))
        .when(form == 1, json("turn"))
        .when(form == 2, json("turn", n.alias("text")))
        .when(form == 3, F.col("text"))
        .when(form == 5, json("turn", "text", n.alias("extra")))
    )
    tool = F.when(n % 5 == 4, "other").when(n % 2 == 0, "reply").otherwise("follow")
    is_call = F.col("role").isin("user", "system")
    calls = row.where(is_call).select(
        "conv_id", "turn", F.when(n % 11 != 0, named(n)).alias("id"), tool.alias("name"), arguments.alias("arguments"),
        F.when(n % 3 != 0, F.array(named(F.floor(n / 7)))).alias("after"),
    )
    results = row.where(~is_call).select("conv_id", "turn", named(n).alias("id"), "content")
    return calls, results

"""Tool-call linking of chat messages, in DataFrame functions only.

Messages are rows (conv_id, turn, role, text).  A message whose text is a JSON
object with ``tool_calls`` (items ``{"id", "name", "arguments", "after"}``) makes
calls; one with ``tool_call_id`` and ``content`` is a result.

1. Calls and results are hash-joined by (conv_id, call id), after aggregations
   that pick the earliest of repeated ids; the key holds the call's id, so a
   conversation of any length is spread over tasks.
2. Calls are ordered topologically: ``after`` names the call whose result a call
   uses.  Levels come from pointer jumping (a round doubles the distance seen),
   so a chain of n calls takes log2(n) joins, each written to the shared
   checkpoint folder.  (level, turn, call_id) is the order; calls that reach no
   beginning are in a cycle.  Nothing collects a conversation.
3. Arguments are validated against schemas ``{tool: {field: (type, required,
   maximum)}}`` given as a parameter.
4. Each call is serialised as canonical JSON: keys sorted, no white space.

Defined results: status is ``linked``, ``unanswered`` (no result), ``orphan`` (a
result without call), ``cycle`` (no order), or ``repeated`` (a later call of an
id that the conversation has used); calls and results without an id or a
conversation are unanswered or orphans, without a level; a call whose whole row
is repeated is one call; ``after`` that names no call counts as none; arguments
that are no JSON object give the error ``not an object``; messages of other
kinds, null or empty texts give no rows; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

MESSAGE = "struct<tool_calls:array<struct<id:string,name:string,arguments:string,after:string>>,tool_call_id:string,content:string>"
Schemas = dict[str, dict[str, tuple[str, bool, int | None]]]


def parse_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls, results)."""
    parsed = messages.select("conv_id", "turn", F.from_json("text", MESSAGE).alias("m"))
    calls = (parsed.select("conv_id", "turn", F.posexplode("m.tool_calls").alias("item", "c"))
             .select("conv_id", "turn", "item", F.col("c.id").alias("call_id"), "c.name", "c.arguments", "c.after"))
    results = (parsed.where("m.tool_calls IS NULL AND (m.tool_call_id IS NOT NULL OR m.content IS NOT NULL)")
               .select("conv_id", "turn", F.col("m.tool_call_id").alias("call_id"), "m.content"))
    return calls, results


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 for calls that wait for none; null in a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    state = cut(calls.select("conv_id", "call_id", "after").join(known, ["conv_id", "after"], "left")
                .select("conv_id", "call_id", F.when(F.col("known"), F.col("after")).alias("up"))
                .withColumn("distance", F.when(F.col("up").isNull(), 0).otherwise(1)))
    rounds = max(1, state.count()).bit_length()
    for _ in range(rounds):  # beyond log2 of the number of calls, only cycles are left
        open_ = state.where("up IS NOT NULL").count()
        if not open_:
            break
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("distance").alias("more"))
        state = cut(state.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "call_id", F.col("next").alias("up"), (F.col("distance") + F.coalesce("more", F.lit(0))).alias("distance")))
    return state.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("distance")).alias("level"))


_TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN"}


def errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as sorted strings."""
    value = F.try_parse_json(arguments)
    found = []
    for tool, fields in schemas.items():
        for field, (kind, required, maximum) in fields.items():
            one = F.try_variant_get(value, f"$.{field}", "variant")
            is_null = one.isNull() | F.coalesce(F.is_variant_null(one), F.lit(False))
            wrong = F.when(is_null, F.lit(f"{field} is missing") if required else F.lit(None))
            wrong = wrong.when(F.schema_of_variant(one) != _TYPES[kind], F.lit(f"{field} is no {kind}"))
            if maximum is not None:
                wrong = wrong.when(F.try_variant_get(value, f"$.{field}", "bigint") > maximum, F.lit(f"{field} is over {maximum}"))
            found.append(F.when(name == tool, wrong))
    is_object = F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))
    return (F.when(~F.coalesce(name.isin(list(schemas)), F.lit(False)), F.array(F.lit("unknown tool")))
            .when(~is_object, F.array(F.lit("not an object")))
            .otherwise(F.array_sort(F.array_compact(F.array(*found)))))


def link_calls(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """A row per call and per orphan result: conv_id, turn, call_id, level, status, n_errors, json."""
    calls, results = parse_messages(messages)
    calls = cut(calls)
    named = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    single = (named.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "item", "name", "arguments", "after")).alias("c"))
              .select("conv_id", "call_id", "c.*"))
    place = single.select("conv_id", "call_id", F.struct("turn", "item").alias("place"))
    later = named.join(place, ["conv_id", "call_id"]).where(F.struct("turn", "item") != F.col("place")).drop("place")
    answers = (results.where("call_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("answer")))
    order = levels(single)
    linked = (single.join(answers, ["conv_id", "call_id"], "left").join(order, ["conv_id", "call_id"], "left")
              .withColumn("status", F.when(F.col("level").isNull(), "cycle").when(F.col("answer").isNull(), "unanswered").otherwise("linked")))
    others = (later.withColumn("status", F.lit("repeated"))
              .unionByName(calls.where("conv_id IS NULL OR call_id IS NULL").withColumn("status", F.lit("unanswered"))))
    orphans = (results.join(single.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")
               .withColumn("status", F.lit("orphan")).withColumn("answer", F.struct("turn", "content")).drop("content"))
    rows = linked.unionByName(others, allowMissingColumns=True).unionByName(orphans, allowMissingColumns=True)
    wrong = F.when(F.col("status") == "orphan", F.array().cast("array<string>")).otherwise(errors(F.col("name"), F.col("arguments"), schemas))
    rows = rows.withColumn("errors", wrong)
    sealed = F.to_json(F.struct(
        F.try_parse_json("arguments").alias("arguments"), F.col("call_id"), F.col("answer.content").alias("content"), F.col("conv_id"),
        F.col("errors"), F.col("level"), F.col("name"), F.col("status"), F.col("turn")))
    return rows.select("conv_id", "turn", "call_id", F.col("level").cast("int").alias("level"), "status",
                       F.size("errors").cast("int").alias("n_errors"), sealed.alias("json"))


#: The tools that the registered query's derived messages call.
QUERY_SCHEMAS: Schemas = {
    "lookup": {"text": ("string", True, None), "words": ("integer", True, 30)},
    "summarise": {"text": ("string", True, None), "words": ("integer", True, None)},
    "translate": {"text": ("string", True, None), "lang": ("string", True, None)},
}


def as_tool_messages(conversations: DataFrame) -> DataFrame:
    """Conversations without tool calls, seen as some: a user turn calls a tool, the next assistant turn is its result.

    The tool is chosen by the text's length, its arguments come from the
    text; a call waits for the conversation's call two turns before.
    """
    call_id = F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string"))
    kind = F.char_length(F.coalesce("text", F.lit(""))) % 3
    arguments = F.to_json(F.struct(F.size(F.split(F.trim("text"), " ")).alias("words"), F.col("text")))
    call = F.struct(call_id.alias("id"), F.when(kind == 0, "lookup").when(kind == 1, "summarise").otherwise("translate").alias("name"),
                    arguments.alias("arguments"),
                    F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 2).cast("string")).alias("after"))
    result = F.struct(F.concat(F.lit("call_"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("tool_call_id"),
                      F.coalesce("text", F.lit("")).alias("content"))
    return conversations.select(
        "conv_id", "turn", "role",
        F.when(F.col("role") == "user", F.to_json(F.struct(F.array(call).alias("tool_calls")))).when(F.col("role") == "assistant", F.to_json(result)).alias("text"))

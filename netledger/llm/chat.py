"""Chat formatting: tool calls and their results, linked, ordered, validated and written as canonical JSON.

Messages carry JSON: an assistant's ``{"tool_calls": [{"id", "name", "arguments", "after"}]}`` and a tool's
``{"tool_call_id", "content"}``. Text beside an assistant's calls is a message of its own before them (place -1). Each message is parsed
once, into a written table. Calls and results of a conversation are linked by a hash join on the identifier with one row of facts per
identifier, so an identifier that many rows share never multiplies them, and Spark can split its join.

``after`` names calls whose results a call uses. A call's level is the pass over the conversation, in the order of its turns, in which it
can run: the greatest level of its references, and one more if that reference does not stand before it. So level 0 means the same everywhere (all that it
needs stands before it and is of level 0), and order by level, turn, place is topological. Calls on a cycle, or that need one, get level -1.
Levels are found round by round, with as many rounds as the longest chain of references in a conversation that has one pointing forward.

Arguments are checked against the schema of their tool. The record is JSON without spaces, with sorted keys at every depth; arguments that
are no JSON, or repeat a key, are kept as they came, as ``arguments_text``. A number without a fraction is an integer, as it is written.

Only built-in column functions run here. Defined results: text that is null, empty or not such JSON is a plain message (kind ``message``); a call
without id is ``unidentified``; of calls that share an id the first is linked and the others are ``duplicate``; of results that share one the first
is linked, others are ``repeated``; a result without call is ``orphan``; repeated rows are calls of their own (ties of turn and place share their
status); texts of any length are read whole; an empty table gives no rows. Other columns are dropped; a conversation or turn column that is named like one
of the result's other columns is returned as ``conv_id`` or ``turn``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.llm.common import discarding, written

MESSAGE = ("tool_calls array<struct<id: string, name: string, arguments: string, after: array<string>>>, "
           "tool_call_id string, content string")
#: A tool's fields: type (string, integer, number, boolean, object, array) and whether it must be there.
Schema = dict[str, tuple[str, bool]]
_TYPES = {"string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
          "boolean": r"^BOOLEAN$", "object": r"^OBJECT", "array": r"^ARRAY"}


def problems(name: Column, arguments: Column, schemas: dict[str, Schema]) -> Column:
    """What is wrong with a call's arguments, as an array of short texts."""
    value = F.try_parse_json(arguments)
    known = F.lit(None).cast("array<string>")
    for tool, fields in schemas.items():
        checks = [F.when(F.array_size(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, fields)))) > 0,
                         F.concat(F.lit("unknown "), F.array_join(F.array_sort(F.array_except(
                             F.json_object_keys(arguments), F.array(*map(F.lit, fields)))), ",")))]
        for field, (kind, required) in sorted(fields.items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$['{field}']", "variant"))
            missing = F.lit(f"missing {field}") if required else F.lit(None)
            fits = found.rlike(_TYPES[kind])
            if kind == "integer":
                fits = fits | (found.startswith("DECIMAL") & (F.try_variant_get(value, f"$['{field}']", "double") % 1 == 0))
            checks.append(F.when(found.isNull() | (found == "VOID"), missing).when(~fits, F.lit(f"{field} is no {kind}")))
        known = F.when(name == tool, F.array_compact(F.array(*checks))).otherwise(known)
    return (F.when(value.isNull() | ~F.schema_of_variant(value).startswith("OBJECT"), F.array(F.lit("no object")))
            .otherwise(F.coalesce(known, F.array(F.lit("unknown tool")))))


def canonical(json: Column) -> Column:
    """JSON without spaces and with sorted keys (objects of the variant type keep their fields sorted); null if it is none."""
    return F.to_json(F.try_parse_json(json))


def link_tools(messages: DataFrame, schemas: dict[str, Schema], conv: str = "conv_id", turn: str = "turn", role: str = "role",
               text: str = "text") -> DataFrame:
    """One row per message, call or result: conv, turn, place, kind, call_id, status, problems, level, record."""
    spark = messages.sparkSession
    read = messages.select(F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"), F.col(f"`{role}`").alias("_role"),
                           F.col(f"`{text}`").alias("_text"), F.from_json(F.col(f"`{text}`"), MESSAGE).alias("_m"))
    is_call = (F.col("_role") == "assistant") & (F.size("_m.tool_calls") > 0)
    is_result = (F.col("_role") == "tool") & F.col("_m.tool_call_id").isNotNull()
    kind = F.when(is_call, "call").when(is_result, "result").otherwise("message")
    read = written(read.select("_conv", "_turn", "_role", kind.alias("kind"), F.when(kind == "message", F.col("_text")).alias("_text"),
                               F.col("_m.tool_calls").alias("_calls"), F.col("_m.tool_call_id").alias("call_id"),
                               F.col("_m.content").alias("content")), "messages")

    def key(identifier: str) -> Column:
        return F.to_json(F.struct(F.col("_conv").alias("c"), F.col(identifier).alias("i")))

    at = F.struct(F.col("_turn").alias("t"), F.col("place").alias("p"))
    calls = (read.filter("kind = 'call'").select("_conv", "_turn", F.posexplode("_calls").alias("place", "_c"))
             .select("_conv", "_turn", "place", F.col("_c.id").alias("call_id"), F.col("_c.name").alias("name"),
                     F.col("_c.arguments").alias("arguments"), F.col("_c.after").alias("after"), at.alias("_at")))
    calls = calls.withColumn("_key", F.when(F.col("call_id").isNotNull(), key("call_id")).otherwise(
        F.concat(F.lit("-"), F.to_json(F.struct("_conv", "_turn", "place")))))
    results = read.filter("kind = 'result'").select("_conv", "_turn", "call_id", "content", key("call_id").alias("_key"))
    # One row per identifier, written before the joins: they have one exchange each, which Spark may split at a hot identifier.
    asked = calls.select("_key", "_at", F.lit(None).cast(read.schema["_turn"].dataType).alias("_answer"), F.lit(False).alias("_is"))
    answers = results.select("_key", F.lit(None).cast(calls.schema["_at"].dataType).alias("_at"), F.col("_turn").alias("_answer"), F.lit(True).alias("_is"))
    facts = written(asked.unionByName(answers).groupBy("_key").agg(
        F.min("_at").alias("_first"), F.min("_answer").alias("_answered"), F.max("_is").alias("_has")), "facts")
    levels = _levels(calls, facts.filter("_first IS NOT NULL").select("_key", "_first"))
    if not levels.isEmpty():
        facts = written(facts.join(levels, "_key", "left"), "facts")
    else:
        facts = facts.withColumn("level", F.lit(0))

    call_status = (F.when(F.col("call_id").isNull(), "unidentified").when(F.col("_at") != F.col("_first"), "duplicate")
                   .when(~F.col("_has"), "unanswered").when(F.col("_answered") < F.col("_turn"), "early").otherwise("linked"))
    wrong, parsed = problems(F.col("name"), F.col("arguments"), schemas), F.try_parse_json("arguments")
    level = F.coalesce("level", F.lit(0)).cast("int").alias("level")
    out_calls = calls.join(facts, "_key", "left").select(
        "_conv", "_turn", "place", F.lit("call").alias("kind"), "call_id", call_status.alias("status"),
        F.array_join(wrong, "; ").alias("problems"), level,
        F.to_json(F.struct(parsed.alias("arguments"), F.when(parsed.isNull(), F.col("arguments")).alias("arguments_text"),
                           F.col("call_id").alias("id"), F.col("name"), F.lit("tool_call").alias("type"))).alias("record"))
    result_status = (F.when(F.col("_first").isNull(), "orphan").when(F.col("_turn") != F.col("_answered"), "repeated")
                     .when(F.col("_turn") < F.col("_first.t"), "early").otherwise("linked"))
    out_results = results.join(facts, "_key", "left").select(
        "_conv", "_turn", F.lit(0).alias("place"), F.lit("result").alias("kind"), "call_id", result_status.alias("status"),
        F.lit("").alias("problems"), level,
        F.to_json(F.struct(F.col("content"), F.col("call_id").alias("id"), F.lit("tool_result").alias("type"))).alias("record"))
    beside = F.col("kind") == "call"
    plain = read.filter("kind = 'message' OR kind = 'call' AND content <> ''").select(
        "_conv", "_turn", F.when(beside, -1).otherwise(0).alias("place"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit("plain").alias("status"), F.lit("").alias("problems"), F.lit(0).alias("level"),
        F.to_json(F.struct(F.when(beside, F.col("content")).otherwise(F.col("_text")).alias("content"), F.col("_role").alias("role"),
                           F.lit("message").alias("type"))).alias("record"))
    taken = {c.lower() for c in plain.columns}
    return plain.union(out_calls).union(out_results).withColumnsRenamed(
        {"_conv": "conv_id" if conv.lower() in taken else conv, "_turn": "turn" if turn.lower() in taken else turn})


def _levels(calls: DataFrame, first_call: DataFrame) -> DataFrame:
    """(_key, level) of the calls of conversations in which a reference points forward; all other calls are of level 0."""
    spark = calls.sparkSession
    with discarding(spark):
        refers = (calls.filter("call_id IS NOT NULL").select("_conv", "_key", "_at", F.explode("after").alias("_ref"))
                  .withColumn("_ref", F.to_json(F.struct(F.col("_conv").alias("c"), F.col("_ref").alias("i")))))
        targets = first_call.select(F.col("_key").alias("_ref"), F.col("_first").alias("_target"))
        ahead = F.col("_target") >= F.col("_at")
        edges = written(refers.join(targets, "_ref").groupBy("_conv", "_key", "_ref").agg(F.max(ahead.cast("int")).alias("step")), "references")
        forward = written(edges.filter("step = 1").select(F.to_json(F.struct("_conv")).alias("_c")).distinct(), "forward")
        if forward.isEmpty():
            return spark.createDataFrame([], "_key string, level int")
        owner = F.to_json(F.struct("_conv"))
        edges = written(edges.withColumn("_c", owner).join(forward, "_c", "left_semi").select("_key", "_ref", "step"), "edges")
        nodes = written(calls.filter("call_id IS NOT NULL").withColumn("_c", owner).join(forward, "_c", "left_semi").select("_key").distinct(), "nodes")
        done = newest = written(nodes.join(edges, "_key", "left_anti").withColumn("level", F.lit(0)), "levels")
        while not newest.isEmpty():
            reached = edges.join(done.withColumnsRenamed({"_key": "_ref"}), "_ref", "left").groupBy("_key").agg(
                F.max(F.col("level").isNull()).alias("open"), F.max(F.col("level") + F.col("step")).alias("level"))
            newest = written(reached.filter("NOT open").select("_key", "level").join(done, "_key", "left_anti"), "levels")
            done = done.unionByName(newest)
        return written(nodes.join(done, "_key", "left").select("_key", F.coalesce("level", F.lit(-1)).alias("level")), "levels", keep=True)

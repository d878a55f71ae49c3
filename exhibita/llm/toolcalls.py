"""Linking of tool calls and their results in conversations, in DataFrame functions alone."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table, written

#: Per tool the fields of its arguments: name, JSON type, required. Types: string, integer, number, boolean, array, object.
Schemas = dict[str, list[tuple[str, str, bool]]]

#: The tools of the registered query.
TOOLS: Schemas = {
    "search": [("query", "string", True), ("turn", "integer", True)],
    "lookup": [("query", "string", True), ("turn", "integer", True), ("strict", "boolean", False)],
    "fetch": [("turn", "integer", True), ("url", "string", True)],
}
#: How Spark names the types of variant values.
_TYPES = {
    "string": "^STRING$",
    "integer": "^(BIGINT|DECIMAL\\([0-9]+,0\\))$",
    "number": "^(BIGINT|DECIMAL.*|DOUBLE)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*$",
    "object": "^OBJECT<.*$",
}


_ID = ["conv_id", "call_id"]


def _tops(single: DataFrame, scratch: Scratch) -> DataFrame:
    """``(conv_id, call_id, top, dist)`` of calls ``(conv_id, call_id, parent)`` with one parent each.

    ``top`` is the nearest ancestor without a single parent. Each round doubles how far a call sees, so rounds grow
    with the logarithm of the longest chain. Calls that only lead round in a cycle are left out.
    """
    seen = scratch.written(single.select(*_ID, F.col("parent").alias("top"), F.lit(1).alias("dist")))
    before = None
    while True:
        further = seen.select("conv_id", F.col("call_id").alias("top"), F.col("top").alias("next"), F.col("dist").alias("more"))
        found = seen.join(further, ["conv_id", "top"], "left")
        after = found.where("next IS NOT NULL").count()
        if not after or after == before:  # in a round without progress only cycles are left
            return found.where("next IS NULL").select(*_ID, "top", "dist")
        before = after
        step = [F.coalesce("next", "top").alias("top"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist")]
        seen = scratch.written(found.select(*_ID, *step))


def levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)`` of calls ``(conv_id, call_id, parents)`` in topological order.

    A call whose parents are all absent has level 0, any other one more than its highest parent. Calls on a cycle,
    and those that depend on one, have no level. Equal ids in a conversation are one node with the parents of all.
    Chains of single parents are seen through by doubling; after that there is a round of two small jobs for each call
    with several parents on the longest way. A round reads what still waits and what the round before has found, so all
    rounds together take time with the number of such calls on the longest way times the calls that wait for them: say
    100 rounds for a conversation in which 100 calls in a row each name two earlier ones, whatever the number of
    conversations. Nothing is gathered by conversation.
    """
    with Scratch(calls.sparkSession) as scratch:
        return written(_levels(calls, scratch))


def _levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    nodes = scratch.written(calls.select(*_ID).distinct())
    edges = calls.select(*_ID, F.explode("parents").alias("parent")).distinct()
    edges = scratch.written(edges.join(nodes.withColumnRenamed("call_id", "parent"), ["conv_id", "parent"], "left_semi").select(*_ID, "parent"))
    several = edges.groupBy(*_ID).agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
    tops = scratch.written(_tops(several.where("n = 1").select(*_ID, "parent"), scratch))
    fresh = scratch.written(nodes.join(edges, _ID, "left_anti").withColumn("level", F.lit(0)))
    found = [fresh]
    # calls with several parents: each parent stands for the top that it hangs on
    rest = edges.join(several.where("n > 1").select(*_ID), _ID, "left_semi")
    hung = tops.select("conv_id", F.col("call_id").alias("parent"), "top", "dist")
    one = edges.join(several.where("n = 1").select(*_ID), _ID, "left_semi").select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("_one"))
    rest = rest.join(hung, ["conv_id", "parent"], "left").join(one, ["conv_id", "parent"], "left")
    # a parent that is itself a top counts as one step; one that leads into a cycle never gets a level
    top = F.when(F.col("top").isNotNull(), F.col("top")).when(F.col("_one").isNull(), F.col("parent"))
    rest = scratch.written(rest.select(*_ID, top.alias("top"), (F.coalesce("dist", F.lit(0)) + 1).alias("dist"), F.lit(None).cast("int").alias("met")))
    while not rest.isEmpty():
        # only what the round before has found can settle anything now
        own = fresh.select("conv_id", F.col("call_id").alias("top"), "level")
        seen = rest.join(own, ["conv_id", "top"], "left")
        seen = scratch.written(seen.select(*_ID, "top", "dist", F.coalesce("met", F.col("level") + F.col("dist")).alias("met")))
        ready = seen.groupBy(*_ID).agg(F.max("met").alias("level"), F.max(F.col("met").isNull()).alias("waits"))
        fresh = scratch.written(ready.where("NOT waits").select(*_ID, "level"))
        if fresh.isEmpty():
            break
        found.append(fresh)
        rest = scratch.written(seen.join(fresh.select(*_ID), _ID, "left_anti"))
    known = functools.reduce(DataFrame.union, found)
    below = tops.join(known.select("conv_id", F.col("call_id").alias("top"), "level"), ["conv_id", "top"])
    both = known.union(below.select(*_ID, (F.col("level") + F.col("dist")).alias("level")))
    return nodes.join(both, _ID, "left").select(*_ID, "level")


def errors_of(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as a sorted array of texts; empty where they are valid."""
    value = F.try_parse_json(arguments)
    found = F.when(value.isNull(), F.array(F.lit("arguments are no JSON")))
    found = found.when(~F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), F.array(F.lit("arguments are no object")))
    for tool, fields in schemas.items():
        checks = []
        for field, kind, required in fields:
            own = F.try_variant_get(value, f"$['{field}']", "variant")
            bad = ~F.schema_of_variant(own).rlike(_TYPES[kind])
            text = F.when(own.isNull(), F.lit(f"{field}: missing") if required else F.lit(None))
            checks.append(text.when(bad, F.lit(f"{field}: not {kind}")))
        extra = F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f, _, _ in fields]))
        more = F.transform(extra, lambda k: F.concat(k, F.lit(": unknown")))
        own = F.filter(F.array(*checks), lambda x: x.isNotNull())
        found = found.when(name == tool, F.array_sort(F.concat(own, more)))
    return found.otherwise(F.array(F.lit("unknown tool")))


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Each call with its result, level, errors and canonical JSON.

    ``calls``: conv_id, call_id, name, arguments (JSON text), parents (ids of earlier calls); ``results``: conv_id,
    call_id, content. ``status`` is ``linked``, ``unanswered`` or ``orphan`` (a result without a call; all that
    comes from the call is null there). A call with several results takes the smallest content and counts them in
    ``n_results``; repeated calls keep a row each. Null ids match nothing. The canonical JSON has sorted keys, no
    white space and explicit nulls; arguments that are no JSON stand in it as a string. Arguments and contents of any
    length are taken whole. Rows are in order of conversation, level, and call; those that tie come in any order. Other
    input columns, whatever their names, are left out; empty tables give an empty result.
    """
    calls = calls.select("conv_id", "call_id", "name", "arguments", F.coalesce("parents", F.array().cast("array<string>")).alias("parents"))
    answers = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy("conv_id", "call_id")
    answers = answers.agg(F.min("content").alias("content"), F.count("*").alias("n_results"))
    ordered = levels(calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL"))
    named = calls.join(ordered, ["conv_id", "call_id"], "left").withColumn("_call", F.lit(True))
    both = named.join(answers, ["conv_id", "call_id"], "full")
    parsed = F.try_parse_json("arguments")
    # a malformed argument text stands as a JSON string
    shown = F.coalesce(F.to_json(parsed), F.to_json(F.array("arguments")).substr(F.lit(2), F.length(F.to_json(F.array("arguments"))) - 2))
    text = lambda c: F.coalesce(F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"), F.lit("null"))
    line = F.concat(
        F.lit('{"arguments":'), F.coalesce(shown, F.lit("null")),
        F.lit(',"id":'), text("call_id"),
        F.lit(',"level":'), F.coalesce(F.col("level").cast("string"), F.lit("null")),
        F.lit(',"name":'), text("name"),
        F.lit(',"result":'), text("content"),
        F.lit("}"),
    )
    wrong = errors_of(F.col("name"), F.col("arguments"), schemas)
    out = both.select(
        "conv_id",
        "call_id",
        F.when(F.col("_call").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status"),
        "level",
        F.coalesce("n_results", F.lit(0).cast("long")).alias("n_results"),
        F.when(F.col("_call"), wrong).alias("errors"),
        F.when(F.col("_call"), line).alias("canonical"),
    )
    return out.repartitionByRange("conv_id", "level", "call_id").sortWithinPartitions("conv_id", "level", "call_id")


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read into plain conversations: a user turn calls a tool, the turn after it answers.

    Some calls lack a field, carry one of the wrong type, or are cut off, by fixed rules on the ids, so that every
    outcome occurs.
    """
    turn, conv = F.col("turn"), F.col("conv_id")
    query = F.expr("substring(to_json(array(text)), 2, length(to_json(array(text))) - 2)")
    whole = F.concat(F.lit('{ "turn" : '), turn.cast("string"), F.lit(' , "query": '), F.coalesce(query, F.lit("null")), F.lit(" }"))
    typed = F.concat(F.lit('{"turn": "'), turn.cast("string"), F.lit('", "query": '), F.coalesce(query, F.lit("null")), F.lit("}"))
    kind = conv % 11
    arguments = F.when(kind == 3, typed).when(kind == 5, whole.substr(F.lit(1), F.length(whole) - 1)).otherwise(whole)
    name = F.when((conv + turn) % 3 == 0, "search").when((conv + turn) % 3 == 1, "lookup").otherwise(F.when(conv % 2 == 0, "fetch").otherwise("guess"))
    calls = conversations.where("role = 'user'").select(
        "conv_id",
        F.concat(F.lit("c"), turn.cast("string")).alias("call_id"),
        name.alias("name"),
        arguments.alias("arguments"),
        F.array(F.concat(F.lit("c"), (turn - 2).cast("string"))).alias("parents"),
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id", F.concat(F.lit("c"), (turn - 1).cast("string")).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results


def op2_tool_calls(spark, sf_dir: str) -> DataFrame:
    """Every tool call of every conversation, linked, ordered, validated and in canonical JSON."""
    found = link(*calls_of(table(spark, sf_dir, "conversations")), TOOLS)
    return found.withColumn("errors", F.array_join("errors", "; "))


ORACLE = """
WITH calls AS (
  SELECT conv_id, turn, 'c' || turn AS call_id, text,
         CASE (conv_id + turn) % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE CASE WHEN conv_id % 2 = 0 THEN 'fetch' ELSE 'guess' END END AS name
  FROM conversations WHERE role = 'user'
), answers AS (
  SELECT conv_id, 'c' || (turn - 1) AS call_id, min(text) AS content, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY 1, 2
), chain AS (
  SELECT conv_id, turn, turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS run FROM (SELECT DISTINCT conv_id, turn FROM calls)
), levels AS (
  SELECT conv_id, 'c' || turn AS call_id, CAST(row_number() OVER (PARTITION BY conv_id, turn % 2, run ORDER BY turn) - 1 AS INT) AS level FROM chain
), named AS (
  SELECT c.*, l.level, true AS is_call FROM calls c JOIN levels l USING (conv_id, call_id)
)
SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, coalesce(c.call_id, a.call_id) AS call_id,
       CASE WHEN is_call IS NULL THEN 'orphan' WHEN n IS NULL THEN 'unanswered' ELSE 'linked' END AS status, level, coalesce(n, 0) AS n_results,
       CASE WHEN is_call IS NULL THEN NULL WHEN c.conv_id % 11 = 5 THEN 'arguments are no JSON' ELSE
         CASE WHEN name = 'guess' THEN 'unknown tool'
              WHEN name = 'fetch' THEN concat_ws('; ', 'query: unknown', CASE WHEN c.conv_id % 11 = 3 THEN 'turn: not integer' END, 'url: missing')
              ELSE CASE WHEN c.conv_id % 11 = 3 THEN 'turn: not integer' ELSE '' END END END AS errors,
       CASE WHEN is_call THEN '{"arguments":' ||
         CASE c.conv_id % 11 WHEN 3 THEN '{"query":' || to_json(text) || ',"turn":"' || turn || '"}'
              WHEN 5 THEN to_json('{ "turn" : ' || turn || ' , "query": ' || to_json(text) || ' ')
              ELSE '{"query":' || to_json(text) || ',"turn":' || turn || '}' END
         || ',"id":"' || c.call_id || '","level":' || level || ',"name":"' || name || '","result":' || coalesce(to_json(content), 'null') || '}' END AS canonical
FROM named c FULL JOIN answers a ON c.conv_id = a.conv_id AND c.call_id = a.call_id
"""

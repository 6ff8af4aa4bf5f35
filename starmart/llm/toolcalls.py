"""Linking tool calls with their results (operator 2). Only DataFrame and SQL functions.

Messages are ``conv_id, turn, role, text``. An assistant's text may be JSON with
``tool_calls``, each ``{"id", "name", "arguments", "after": [ids]}``; a tool's text is
``{"tool_call_id", "content"}``. Calls and results meet in a join on conversation and
identifier, calls are ordered so that each comes after those it waits for, arguments are
checked against the tool's schema, and each conversation becomes one JSON text with sorted
keys and no spaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starmart.llm.common import stored, table

CALLS = (
    "struct<tool_calls:array<struct<id:string,name:string,arguments:variant,after:array<string>>>>"
)
RESULT = "struct<tool_call_id:string,content:string>"
#: Turns of one block.
TURNS = 1024
SCHEMA = "name string, field string, type string, required boolean, max_length int, minimum double"


def calls_of(messages: DataFrame) -> DataFrame:
    """``conv_id, call_id, turn, nth, name, arguments, after, n_copies``.

    Of equal ids the first call counts: by turn, place, name, arguments and what it waits for.
    ``n_copies`` is the number of calls with the id.
    """
    return (
        messages.where("role = 'assistant'")
        .select("conv_id", "turn", F.from_json("text", CALLS)["tool_calls"].alias("calls"))
        .select("conv_id", "turn", F.posexplode("calls").alias("nth", "c"))
        .where("c.id IS NOT NULL")
        .select(
            "conv_id",
            F.col("c.id").alias("call_id"),
            F.struct(
                "turn",
                "nth",
                F.col("c.name").alias("name"),
                F.to_json("c.arguments").alias("arguments"),
                F.coalesce("c.after", F.array().cast("array<string>")).alias("after"),
            ).alias("call"),
        )
        .groupBy("conv_id", "call_id")
        .agg(F.min("call").alias("call"), F.count("*").alias("n_copies"))
        .select("conv_id", "call_id", "call.*", "n_copies")
        .withColumn("arguments", F.parse_json("arguments"))
    )


def results_of(messages: DataFrame) -> DataFrame:
    """``r_conv, r_id, r_turn, content, n_results``: the first result of each identifier."""
    return (
        messages.where("role = 'tool'")
        .select("conv_id", "turn", F.from_json("text", RESULT).alias("r"))
        .where("r.tool_call_id IS NOT NULL")
        .groupBy(F.col("conv_id").alias("r_conv"), F.col("r.tool_call_id").alias("r_id"))
        .agg(
            F.min(F.struct("turn", "r.content")).alias("first"),
            F.count("*").alias("n_results"),
        )
        .select("r_conv", "r_id", F.col("first.turn").alias("r_turn"), "first.content", "n_results")
    )


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """The calls with ``errors``: what their arguments lack or have against the schema."""
    fields = schemas.groupBy(F.col("name").alias("tool")).agg(
        F.array_sort(
            F.collect_list(F.struct("field", "type", "required", "max_length", "minimum"))
        ).alias("fields")
    )
    given = "map_contains_key(args, f.field)"
    kind = "schema_of_variant(args[f.field])"
    fits = (
        "CASE f.type WHEN 'string' THEN {k} = 'STRING' WHEN 'integer' THEN {k} = 'BIGINT' "
        "WHEN 'number' THEN {k} = 'BIGINT' OR {k} = 'DOUBLE' OR {k} LIKE 'DECIMAL%' "
        "WHEN 'boolean' THEN {k} = 'BOOLEAN' WHEN 'array' THEN {k} LIKE 'ARRAY%' "
        "WHEN 'object' THEN {k} LIKE 'OBJECT%' ELSE true END"
    ).format(k=kind)
    errors = F.expr(
        "CASE WHEN fields IS NULL THEN array('unknown tool') "
        "WHEN args IS NULL THEN array('arguments are no object') ELSE array_sort(concat("
        f"transform(filter(fields, f -> f.required AND NOT {given}), "
        "f -> concat('missing ', f.field)), "
        "transform(filter(map_keys(args), k -> NOT exists(fields, f -> f.field = k)), "
        "k -> concat('unknown ', k)), "
        f"transform(filter(fields, f -> {given} AND NOT ({fits})), f -> concat('type ', f.field)), "
        f"transform(filter(fields, f -> {given} AND f.max_length IS NOT NULL AND {kind} = 'STRING' "
        "AND length(try_variant_get(args[f.field], '$', 'string')) > f.max_length), "
        "f -> concat('length ', f.field)), "
        f"transform(filter(fields, f -> {given} AND f.minimum IS NOT NULL "
        "AND try_variant_get(args[f.field], '$', 'double') < f.minimum), "
        "f -> concat('minimum ', f.field)))) END"
    )
    return (
        calls.join(fields, calls["name"] == fields["tool"], "left")
        .withColumn("args", F.from_json(F.to_json("arguments"), "map<string,variant>"))
        .withColumn("errors", errors)
        .drop("args", "fields", "tool")
    )


def ranked(calls: DataFrame) -> DataFrame:
    """``r_key, r_call, rank`` of each call; the rank is NULL for calls that wait in a circle.

    The rank is the length of the longest chain of calls up to this one. Every call has rows
    ``(of, floor)``: its rank is at least ``floor`` above that of the call ``of``, or at least
    ``floor`` if ``of`` is NULL. In each round a row's call is replaced by what that call waits
    for itself, if it is one call at most, so a chain's reach doubles; rounds end when none
    gets its rank. Identifiers that name no call of the conversation are not waited for.
    """
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    known = calls.select(key.alias("key"), F.col("call_id").alias("id"))
    waits = calls.select(
        key.alias("key"), F.col("call_id").alias("id"), F.explode("after").alias("of")
    ).distinct()
    waits = waits.join(known.withColumnRenamed("id", "of"), ["key", "of"], "left_semi")
    none = F.lit(None).cast("string")
    rows = waits.select("key", "id", "of", F.lit(1).cast("bigint").alias("floor")).union(
        known.select("key", "id", none, F.lit(1).cast("bigint"))
    )
    rows, open_before = stored(rows, "waits"), -1
    while True:
        state = rows.groupBy("key", "id").agg(
            F.count("of").alias("open"),
            F.max(F.when(F.col("of").isNull(), F.col("floor"))).alias("rank"),
            F.max("of").alias("next"),
            F.max(F.when(F.col("of").isNotNull(), F.col("floor"))).alias("step"),
        )
        n_open = rows.where("of IS NOT NULL").select("key", "id").distinct().count()
        if n_open in (0, open_before):
            break
        open_before = n_open
        before = state.select(
            "key", F.col("id").alias("of"), "open", "rank", "next", "step"
        )
        # circles would go on growing; no chain has 2^40 calls
        put = "least({}, 1099511627776L)"
        moved = (
            rows.where("of IS NOT NULL")
            .join(before, ["key", "of"])
            .select(
                "key",
                "id",
                F.explode(
                    F.expr(
                        "CASE WHEN open > 1 THEN array(named_struct('of', of, 'floor', floor)) "
                        f"WHEN open = 1 THEN array(named_struct('of', next, 'floor', {put.format('floor + step')}), "
                        f"named_struct('of', CAST(NULL AS STRING), 'floor', {put.format('floor + rank')})) "
                        f"ELSE array(named_struct('of', CAST(NULL AS STRING), 'floor', {put.format('floor + rank')})) END"
                    )
                ).alias("e"),
            )
            .select("key", "id", "e.of", "e.floor")
        )
        rows = stored(
            rows.where("of IS NULL").union(moved).groupBy("key", "id", "of").agg(F.max("floor").alias("floor")),
            "waits",
        )
    return state.select(
        F.col("key").alias("r_key"),
        F.col("id").alias("r_call"),
        F.when(F.col("open") == 0, F.col("rank")).alias("rank"),
    )


def link_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per conversation with calls or results.

    ``conv_id, n_calls, n_linked, n_invalid, n_circular, n_orphans, n_repeats, canonical``.
    Calls are listed by rank, turn and place; calls that wait in a circle come last, marked. A
    call without result is unlinked, a result without call an orphan. Of several calls or
    results of one identifier the first is listed and the others are counted in ``n_repeats``.
    Texts that are NULL, empty or no such JSON hold neither. A NULL turn comes first. Calls and
    results with a NULL ``conv_id`` link with each other, but belong to no conversation: each
    call, and each orphan, has a row of its own. Identifiers that are NULL are skipped.
    """
    calls = stored(calls_of(messages), "calls")
    results = results_of(messages)
    both = validated(calls, schemas).join(
        results,
        calls["conv_id"].eqNullSafe(results["r_conv"]) & (calls["call_id"] == results["r_id"]),
        "full",
    )
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("null"))
    ranks = ranked(calls)
    both = both.join(ranks, (key == ranks["r_key"]) & (F.col("call_id") == ranks["r_call"]), "left")
    is_call = F.col("call_id").isNotNull()
    text = F.to_json(
        F.struct(
            F.array_sort("after").alias("after"),
            "arguments",
            F.when(F.col("rank").isNull(), F.lit(True)).alias("circular"),
            "errors",
            F.col("call_id").alias("id"),
            "name",
            F.col("content").alias("result"),
            "turn",
        )
    )
    entry = F.struct(
        F.coalesce("rank", F.lit(2**62)).alias("rank"), "turn", "nth", "call_id", text.alias("text")
    )
    conv = F.coalesce("conv_id", "r_conv")
    count = lambda x: F.count(F.when(is_call & x, 1)).cast("int")
    grouped = both.groupBy(
        conv.alias("conv_id"), F.when(conv.isNull(), F.coalesce("call_id", "r_id")).alias("alone")
    ).agg(
        count(F.lit(True)).alias("n_calls"),
        count(F.col("n_results").isNotNull()).alias("n_linked"),
        count(F.size("errors") > 0).alias("n_invalid"),
        count(F.col("rank").isNull()).alias("n_circular"),
        F.array_sort(F.collect_list(F.when(is_call, entry))).alias("listed"),
        F.array_sort(F.collect_list(F.when(~is_call, F.col("r_id")))).alias("orphans"),
        F.sum(
            F.coalesce(F.col("n_copies") - 1, F.lit(0)) + F.coalesce(F.col("n_results") - 1, F.lit(0))
        ).alias("n_repeats"),
    )
    listed = F.array_join(F.transform("listed", lambda c: c["text"]), ",")
    rest = F.substr(F.to_json(F.struct("conv_id", "orphans")), F.lit(2))
    return grouped.select(
        "conv_id",
        "n_calls",
        "n_linked",
        "n_invalid",
        "n_circular",
        F.size("orphans").alias("n_orphans"),
        "n_repeats",
        F.concat(F.lit('{"calls":['), listed, F.lit("],"), rest).alias("canonical"),
    )


def as_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations as tool traffic: who asks is a caller, who answers a tool.

    A system turn calls ``instruct``, another turn ``ask``, each after the call of the nearest
    such turn with a lower number; an assistant turn is the result of that call, or of none. A
    NULL turn comes before all others. A NULL role calls a tool without a name, which no schema
    knows. Every message has a call or result: ids hold turn, role and a digest of the text, so
    only messages equal in all columns share one, and ``link_calls`` counts those. Of several
    calls at one turn, the one with the greatest id is the one answered and waited for. Messages
    with a NULL ``conv_id`` have none before them.
    """
    answers = F.col("role").eqNullSafe("assistant")
    said = F.concat_ws(
        "-",
        F.coalesce(F.col("turn").cast("string"), F.lit("null")),
        F.coalesce("role", F.lit("null")),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")),
    )
    rows = (
        conversations.select("conv_id", "turn", "role", "text")
        .withColumn("own", F.when(~answers, F.concat(F.lit("call-"), said)))
        .withColumn("lone", F.when(answers, F.concat(F.lit("none-"), said)))
        .withColumn("place", F.coalesce("turn", F.lit(-(2**63))))
    )
    # within blocks of turns, then over blocks, so that no long conversation is one task's work
    turns = (
        rows.where("conv_id IS NOT NULL")
        .groupBy("conv_id", "place")
        .agg(F.max("own").alias("asks"))
        .withColumn("block", F.expr(f"place div {TURNS}"))
    )
    inside = W.partitionBy("conv_id", "block").orderBy("place").rowsBetween(W.unboundedPreceding, -1)
    over = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = turns.groupBy("conv_id", "block").agg(
        F.max_by("asks", F.when(F.col("asks").isNotNull(), F.col("place"))).alias("top")
    )
    blocks = blocks.select("conv_id", "block", F.last("top", True).over(over).alias("earlier"))
    turns = (
        turns.withColumn("near", F.last("asks", True).over(inside))
        .join(blocks, ["conv_id", "block"])
        .select("conv_id", "place", F.coalesce("near", "earlier").alias("above"))
    )
    rows = rows.join(turns, ["conv_id", "place"], "left")
    call = F.to_json(
        F.struct(
            F.array(
                F.struct(
                    F.col("own").alias("id"),
                    F.when(F.col("role") == "system", "instruct")
                    .when(F.col("role").isNotNull(), "ask")
                    .alias("name"),
                    F.struct("turn", F.col("text").alias("prompt")).alias("arguments"),
                    F.array_compact(F.array("above")).alias("after"),
                )
            ).alias("tool_calls")
        )
    )
    result = F.to_json(
        F.struct(
            F.coalesce("above", "lone").alias("tool_call_id"),
            F.col("text").alias("content"),
        )
    )
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("own").isNull(), "tool").otherwise("assistant").alias("role"),
        F.when(F.col("own").isNull(), result).otherwise(call).alias("text"),
    )


def conversation_tools(spark: SparkSession) -> DataFrame:
    """The schemas of the two tools that plain conversations call."""
    return spark.sql(
        "SELECT * FROM VALUES ('ask', 'prompt', 'string', true, 400, NULL), "
        "('ask', 'turn', 'integer', true, NULL, 0D), "
        "('instruct', 'prompt', 'string', true, NULL, NULL), "
        "('instruct', 'turn', 'integer', true, NULL, 0D) "
        "AS t(name, field, type, required, max_length, minimum)"
    )


def op2_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = as_messages(table(spark, sf_dir, "conversations"))
    linked = link_calls(messages, conversation_tools(spark))
    return linked.withColumn("canonical_sha256", F.sha2(F.col("canonical").cast("binary"), 256))

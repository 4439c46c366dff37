"""Tool calls linked to their results, in native DataFrame operations.

Calls and results meet by a hash join on (conversation, call id). Arguments are
checked against the tool's schema, calls are put in topological order (a call after
those whose results its arguments refer to), and each linked call is serialised as
canonical JSON: keys in code-point order at every depth, no white space, strings with
the least escapes, numbers as they are spelt, nulls written. What is no JSON becomes a
JSON string of its raw text, so that the whole is JSON whatever the arguments hold.

Rows are calls, never whole conversations, so a conversation of any length spreads
over tasks. No Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

#: JSON types that a schema may name, with a test on a value that is known to be JSON.
JSON_TYPES = {
    "string": "^\"",
    "integer": r"^-?\d+$",
    "number": r"^-?\d",
    "boolean": "^(true|false)$",
    "array": r"^\[",
    "object": r"^\{",
    "null": "^null$",
}


def json_text(value: Column) -> Column:
    """A JSON string literal, or null as JSON null."""
    quoted = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(quoted, F.lit(6), F.length(quoted) - 6))


def canonical_object(fields: dict[str, Column]) -> Column:
    """A JSON object of raw JSON values, keys in code-point order."""
    parts = []
    for i, name in enumerate(sorted(fields)):
        parts.append(F.concat(F.lit(f'{"," if i else ""}"{name}":'), F.coalesce(fields[name], F.lit("null"))))
    return F.concat(F.lit("{"), *parts, F.lit("}"))


_NUMBER = r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?"
#: Strings (without escapes), numbers and the rest of JSON.
_TOKEN = rf'"[^"]*"|{_NUMBER}|true|false|null|[\[\]{{}}:,]'


def trimmed(value: Column) -> Column:
    """Raw JSON without JSON's white space around it."""
    return F.regexp_replace(value, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def canonical_json(value: Column) -> Column:
    """One raw JSON value with sorted keys and without white space; null for anything else.

    JSON is what Spark's variant can hold: no repeated keys, and a bounded size.
    """

    def read(bare: Column) -> Column:
        # the variant does not mind what comes after a value, so that the end is looked for too
        ended = F.rlike(_unescaped(bare), F.lit(r'^"[^"]*"$'))
        string = F.when(ended, F.try_variant_get(F.try_parse_json(bare), "$", "string"))
        return (
            F.when(bare.startswith('"'), _once(string, lambda s: F.when(s.isNotNull(), json_text(s))))
            .when(F.rlike(bare, F.lit(r"^[\[{]")), _sorted_keys(bare))
            .when(F.rlike(bare, F.lit(rf"^(?:{_NUMBER}|true|false|null)$")), bare)
        )

    return _once(trimmed(value), read)


def canonical_value(value: Column) -> Column:
    """canonical_json, or a JSON string of what is no JSON."""
    return F.when(value.isNotNull(), F.coalesce(canonical_json(value), json_text(value)))


def _unescaped(value: Column) -> Column:
    """Raw JSON with control characters in place of escaped backslashes and quotes."""
    return F.regexp_replace(F.replace(value, F.lit("\\\\"), F.lit("\x01")), r'\\"', "\x02")


def _sorted_keys(value: Column) -> Column:
    """A JSON object or array with sorted keys and no white space; null for what does not parse.

    Spark's variant parses and sorts. To keep numbers as written and keys in code-point
    order it is given strings only: ``n`` and a number, or ``s`` and the hex of a string's
    UTF-8.
    """
    text = _unescaped(value)

    def literal(token: Column) -> Column:
        raw = F.replace(F.replace(token, F.lit("\x02"), F.lit('\\"')), F.lit("\x01"), F.lit("\\\\"))
        return F.try_variant_get(F.try_parse_json(raw), "$", "string")

    def packed(token: Column) -> Column:
        string = F.concat(F.lit('"s'), F.hex(F.encode(literal(token), "UTF-8")), F.lit('"'))
        number = F.concat(F.lit('"n'), token, F.lit('"'))
        return F.when(token.startswith('"'), string).when(F.rlike(token, F.lit(r"^[-\d]")), number).otherwise(token)

    def unpacked(token: Column) -> Column:
        inner = F.substring(token, F.lit(3), F.length(token) - 3)
        string = json_text(F.decode(F.unhex(inner), "UTF-8"))
        return F.when(token.startswith('"s'), string).when(token.startswith('"n'), inner).otherwise(token)

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    whole = F.rlike(F.regexp_replace(text, _TOKEN, ""), F.lit(r"^[ \t\r\n]*$")) & ~F.rlike(value, F.lit("[\x01\x02]"))
    # a space between tokens, so that none join: [1 2] is no JSON
    made = F.to_json(F.try_parse_json(F.array_join(F.transform(tokens, packed), " ", "?")))
    again = F.regexp_extract_all(made, F.lit(_TOKEN), F.lit(0))
    # what comes after a value is not parsed, and its tokens would be missing
    return F.when(whole & (F.size(again) == F.size(tokens)), F.array_join(F.transform(again, unpacked), ""))


def read_arguments(arguments: Column) -> Column:
    """array<struct<key, raw, json>> of map<string, raw JSON>, keys in code-point order.

    ``json`` is the canonical value, null for what is no JSON. Null arguments are none.
    """
    entries = F.map_entries(F.coalesce(arguments, F.create_map().cast("map<string,string>")))
    order = lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0)
    return F.transform(
        F.array_sort(entries, order),
        lambda e: F.struct(e["key"].alias("key"), e["value"].alias("raw"), canonical_json(e["value"]).alias("json")),
    )


def canonical_object_of(read: Column) -> Column:
    """A canonical object of read arguments; what is no JSON is a string of its raw text."""
    value = lambda e: F.coalesce(e["json"], json_text(e["raw"]))
    pairs = F.transform(read, lambda e: F.concat(json_text(e["key"]), F.lit(":"), value(e)))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def canonical_arguments(arguments: Column) -> Column:
    """Arguments as a canonical object from map<string, string> of raw JSON values."""
    return canonical_object_of(read_arguments(arguments))


def argument_errors(read: Column, schema: Column) -> Column:
    """Sorted messages where read arguments break their schema; empty if they hold.

    ``schema`` is an array of structs (name, type, required). A tool without schema
    (null) is unknown. A value that is no JSON is an error of its own; null and an
    absent type accept any value.
    """
    named = lambda e, kind: F.concat(F.lit(kind), e["key"])
    keys = F.transform(read, lambda e: e["key"])
    missing = F.filter(schema, lambda s: s["required"] & ~F.array_contains(keys, s["name"]))
    missing = F.transform(missing, lambda s: F.concat(F.lit("missing:"), s["name"]))
    known = F.transform(schema, lambda s: s["name"])
    extra = F.transform(F.array_except(keys, known), lambda k: F.concat(F.lit("extra:"), k))

    def mistyped(s: Column, e: Column) -> Column:
        checks = [(s["type"] == name) & ~F.rlike(e["json"], F.lit(pattern)) for name, pattern in JSON_TYPES.items()]
        return (s["name"] == e["key"]) & F.coalesce(reduce(lambda a, b: a | b, checks), F.lit(False))

    wrong = F.filter(read, lambda e: e["json"].isNotNull() & F.exists(schema, lambda s: mistyped(s, e)))
    broken = F.filter(read, lambda e: e["raw"].isNotNull() & e["json"].isNull())
    told = F.concat(missing, extra, F.transform(wrong, lambda e: named(e, "type:")), F.transform(broken, lambda e: named(e, "json:")))
    return F.when(schema.isNull(), F.array(F.lit("unknown-tool"))).otherwise(F.array_sort(told))


def order_levels(spark: SparkSession, calls: DataFrame) -> DataFrame:
    """Adds ``level``; (level, turn, call_id) is a topological order of a conversation.

    Calls are (conv_id, call_id, turn, refs array<string>). Where every reference of
    a conversation is to a call of an earlier turn, turns are the order and the level
    is 0. In the other conversations a call without references has level 0, any other
    one more than the highest level it refers to. A call in a cycle, or behind one,
    gets null. A reference to a call that does not exist in the conversation is
    ignored; of calls that repeat an id the first turn counts.

    Calls with one reference form chains, which are followed by doubling: a chain of n
    calls takes about log2(n) rounds. Only calls with several references are then placed
    in rounds, as many as such calls lie behind one another.
    """
    scratch = Scratch(spark, "tool-order")
    at = calls.groupBy("conv_id", "call_id").agg(F.min("turn").alias("at"))
    edges = calls.select("conv_id", "call_id", F.explode("refs").alias("ref")).distinct()
    target = at.select("conv_id", F.col("call_id").alias("ref"), F.col("at").alias("ref_at"))
    edges = edges.join(target, ["conv_id", "ref"]).join(at, ["conv_id", "call_id"])
    forward = edges.filter(~F.coalesce(F.col("ref_at") < F.col("at"), F.lit(False)))
    peeled = scratch.save(forward.select("conv_id").distinct(), "peeled")
    if peeled.isEmpty():
        return calls.withColumn("level", F.lit(0))
    edges = scratch.save(edges.join(peeled, "conv_id", "left_semi").select("conv_id", "call_id", "ref"), "edges")
    keys = scratch.save(at.join(peeled, "conv_id", "left_semi").select("conv_id", "call_id"), "keys")
    degree = edges.groupBy("conv_id", "call_id").agg(F.count("*").alias("n"), F.min("ref").alias("to"))
    chains = _chain_ends(scratch, degree.filter("n = 1").select("conv_id", "call_id", "to"), keys)
    several = edges.join(degree.filter("n > 1").select("conv_id", "call_id"), ["conv_id", "call_id"], "left_semi")
    hubs = keys.join(degree.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti").withColumn("level", F.lit(0))
    hubs = _placed(scratch, _over_chains(several, chains), scratch.save(hubs, "level-0"))
    ends = hubs.select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("base"))
    linked = chains.filter("NOT endless").join(ends, ["conv_id", "to"])
    linked = linked.select("conv_id", "call_id", (F.col("dist") + F.col("base")).cast("int").alias("level"))
    every = scratch.save(hubs.unionByName(linked), "levels")
    found = peeled.withColumn("__peeled", F.lit(True))
    joined = calls.join(every, ["conv_id", "call_id"], "left").join(found, "conv_id", "left")
    return joined.withColumn("level", F.when(F.col("__peeled"), F.col("level")).otherwise(0)).drop("__peeled")


def _chain_ends(scratch: Scratch, single: DataFrame, keys: DataFrame) -> DataFrame:
    """(conv_id, call_id, to, dist, endless): where chains of single references end.

    Each round a call takes over where its target points, which doubles the distance. A
    distance above the number of calls of the conversation is a walk in circles.
    """
    sizes = keys.groupBy("conv_id").agg(F.count("*").alias("most"))
    hop = single.join(sizes, "conv_id").select("conv_id", "call_id", "to", F.lit(1).cast("long").alias("dist"), "most", F.lit(True).alias("moved"))
    hop, step = scratch.save(hop, "hop-0"), 0
    while not hop.filter("moved AND dist <= most").isEmpty():
        further = hop.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("dist").alias("more"))
        joined = hop.join(further, ["conv_id", "to"], "left")
        step += 1
        made = joined.select(
            "conv_id", "call_id", F.coalesce("next", "to").alias("to"), (F.col("dist") + F.coalesce("more", F.lit(0))).alias("dist"), "most",
            F.col("next").isNotNull().alias("moved"),
        )
        hop = scratch.save(made, f"hop-{step}")
        scratch.drop(f"hop-{step - 1}")
    return hop.select("conv_id", "call_id", "to", "dist", F.col("moved").alias("endless"))


def _over_chains(edges: DataFrame, chains: DataFrame) -> DataFrame:
    """(conv_id, call_id, to, weight): references led to the ends of chains; null where there is none."""
    ends = chains.select("conv_id", F.col("call_id").alias("ref"), F.col("to").alias("end"), "dist", "endless")
    joined = edges.join(ends, ["conv_id", "ref"], "left")
    to = F.when(F.col("end").isNull(), F.col("ref")).when(~F.col("endless"), F.col("end"))
    return joined.select("conv_id", "call_id", to.alias("to"), (F.coalesce("dist", F.lit(0)) + 1).cast("int").alias("weight"))


def _placed(scratch: Scratch, edges: DataFrame, first: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls without references and all that wait for placed ones only."""
    key = ["conv_id", "call_id"]
    edges, levels, step = scratch.save(edges, "waits-0"), [first], 0
    reached = first.limit(0)  # the highest level that a waiting call has met so far
    while not edges.isEmpty() and not levels[-1].isEmpty():
        last = levels[-1].select("conv_id", F.col("call_id").alias("to"), F.col("level").alias("base"))
        met = edges.join(last, ["conv_id", "to"]).select(*key, (F.col("base") + F.col("weight")).alias("level"))
        step += 1
        rest = scratch.save(edges.join(last, ["conv_id", "to"], "left_anti"), f"waits-{step}")
        best = reached.unionByName(met).groupBy(*key).agg(F.max("level").alias("level"))
        best = scratch.save(best.join(rest.select(*key).distinct().withColumn("waits", F.lit(True)), key, "left"), f"met-{step}")
        levels.append(scratch.save(best.filter("waits IS NULL").drop("waits"), f"level-{step}"))
        reached, edges = best.filter("waits").drop("waits"), rest
        scratch.drop(f"waits-{step - 1}", f"met-{step - 1}")
    return reduce(DataFrame.unionByName, levels)


def link_tool_calls(spark: SparkSession, calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """Link, order, check and serialise tool calls; one row per call row.

    ``calls``: conv_id, call_id, turn, tool, arguments map<string, raw JSON>, refs
    array<string>. ``results``: conv_id, call_id, turn, content. ``tools``: tool,
    schema array<struct<name, type, required>>. Only these columns are read and kept,
    whatever others there are; texts and results may be of any length.

    Adds result_turn, result, status (``linked``, ``pending`` without a result,
    ``early`` with a result no later than the call), errors, level and json. A call
    whose id is null links with nothing. Of several results with one id the first
    counts (least turn, then least content); repeated calls with one id each link
    with it. Results that answer no call are left out (see ``orphan_results``). Of
    several schemas of one tool the least counts. An empty table of calls gives an
    empty result, one of results or tools calls that are pending or unknown.
    """
    calls = calls.select("conv_id", "call_id", "turn", "tool", "arguments", "refs")
    schemas = tools.filter(F.col("tool").isNotNull()).groupBy("tool").agg(F.min("schema").alias("tool_schema"))
    first = (
        results.filter(F.col("call_id").isNotNull())
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "content")).alias("r"))
        .select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), F.col("r.content").alias("result"))
    )
    linked = order_levels(spark, calls).join(first, ["conv_id", "call_id"], "left")
    linked = linked.join(schemas, "tool", "left")
    status = (
        F.when(F.col("result_turn").isNull(), "pending").when(F.col("result_turn") <= F.col("turn"), "early").otherwise("linked")
    )
    linked = linked.withColumns({"status": status, "__read": read_arguments(F.col("arguments"))})
    linked = linked.withColumn("errors", argument_errors(F.col("__read"), F.col("tool_schema")))
    fields = {
        "arguments": canonical_object_of(F.col("__read")),
        "id": json_text(F.col("call_id")),
        "name": json_text(F.col("tool")),
        "result": json_text(F.col("result")),
        "status": json_text(F.col("status")),
    }
    return linked.withColumn("json", canonical_object(fields)).drop("tool_schema", "__read")


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results whose id no call of the conversation has."""
    return results.join(calls.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti")


def turns_as_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations as calls and results: each user or system turn asks the assistant.

    Every turn counts: a user turn is a call of the tool ``reply``, a system turn one of
    ``instruct``, and an assistant turn the result of the turn right before it. Arguments
    are the text, the turn and ``meta``, a nested object. So that linking has work, they
    are spelt with white space and unsorted keys, and by the length of the text some break
    the schema: the turn is a string (a multiple of 5), ``meta`` is absent (of 7), a
    ``note`` is too much (of 11), or ``meta`` is cut off (of 13). By conv_id modulo 15,
    calls refer to the call two turns later (0, 3, 6, 9, 12), two turns earlier
    (1, 4, 7, 10, 13), both, which is a cycle (2), or none.

    A conversation has each turn once: rows equal in conv_id, turn, role and text are one
    turn, however often the table repeats them, and so one call or result.
    ``link_tool_calls`` itself collapses nothing.
    """
    rows = conversations.select("conv_id", "turn", "role", "text").distinct()
    name = lambda turn: F.concat(F.lit("c"), turn.cast("string"))
    turn, chars = F.col("turn").cast("string"), F.coalesce(F.length("text"), F.lit(0))
    words = F.coalesce(F.size(F.split("text", " ")), F.lit(0)).cast("string")
    of = lambda n: chars % n == 0
    meta = F.concat(
        F.lit('{ "words": '), words, F.lit(', "by": {"role":'), json_text(F.col("role")), F.lit(', "chars" : '), chars.cast("string"), F.lit(" } }")
    )
    given = [
        (F.lit(True), "text", json_text(F.col("text"))),
        (F.lit(True), "turn", F.when(of(5), F.concat(F.lit('"'), turn, F.lit('"'))).otherwise(F.concat(F.lit(" "), turn, F.lit(" ")))),
        (~of(7), "meta", F.when(of(13), F.substring(meta, F.lit(1), F.length(meta) - 1)).otherwise(meta)),
        (of(11), "note", F.lit("null")),
    ]
    entries = [F.when(there, F.struct(F.lit(k).alias("key"), v.alias("value"))) for there, k, v in given]
    way = F.pmod(F.col("conv_id"), F.lit(15))
    refs = F.array(
        F.when((way % 3 == 0) | (way == 2), name(F.col("turn") + 2)),
        F.when((way % 3 == 1) | (way == 2), name(F.col("turn") - 2)),
    )
    calls = rows.filter("role IN ('user', 'system')").select(
        "conv_id",
        name(F.col("turn")).alias("call_id"),
        "turn",
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("tool"),
        F.map_from_entries(F.array_compact(F.array(*entries))).alias("arguments"),
        F.array_compact(refs).alias("refs"),
    )
    results = rows.filter("role = 'assistant'").select(
        "conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content")
    )
    return calls, results


def reply_tools(spark: SparkSession) -> DataFrame:
    """The schema of the tool ``reply`` of ``turns_as_calls``; ``instruct`` has none."""
    row = ("reply", [("text", "string", True), ("turn", "integer", True), ("meta", "object", True)])
    return spark.createDataFrame([row], "tool string, schema array<struct<name:string,type:string,required:boolean>>")

"""Chat formatting: links tool calls and their results, orders them, validates arguments, writes canonical JSON.

Calls and results are hash-joined by identifier. Each side is first reduced to one row an identifier, so that repeated
identifiers give no pairs and no hot key has a large table. Messages keep their order, but nothing comes before what it
refers to: the place of a message is the latest of its own and those it refers to, and its level says how many
references lead to it there. Sorted by place and level, the messages of a conversation are in topological order.
Arguments are parsed as variants and checked against the schema of their tool. JSON is canonical: keys in order, no
space, one form for each value.

Chains of references are followed by pointer doubling: a round joins each pointer with the pointer where it leads, so
that a chain of n references takes about log2 n joins by key. There is one row a message; a conversation may have any
number of messages and no conversation is gathered.

Defined results: a call without an identifier or result is ``unanswered``, a result without a call ``orphan``, and
both are ``repeated`` where an identifier occurs more than once in a conversation. A reference to a repeated identifier
means the first message that has it. Messages whose references lead in a circle back to themselves are ``circular``:
they stay at their own place, what refers to them comes after them. References to nothing, or to a message without a
place, have no effect. Messages without a conversation are linked to nothing and keep their place. Arguments that are
null or no JSON object have the error ``not an object``; a tool without a schema gives ``unknown tool``. Null texts and
names are left out of the JSON. Repeated rows are kept, each as a row of its own. Other columns of the input are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.llm.common import discard, stage

#: A schema has the fields of a tool's arguments: (type, required).
Schemas = dict[str, dict[str, tuple[str, bool]]]
#: Fixed names of variant types for the types of schemas.
TYPES = {"string": "STRING", "integer": "BIGINT", "boolean": "BOOLEAN", "object": "OBJECT%", "array": "ARRAY%",
         "number": "BIGINT|DECIMAL%|DOUBLE"}


def argument_errors(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with the arguments (variants) of a call; an empty array if nothing is."""
    none = F.array().cast("array<string>")
    is_object = F.coalesce(F.schema_of_variant(arguments).startswith("OBJECT"), F.lit(False))
    found = F.array(F.lit("unknown tool"))
    for tool, fields in sorted(schemas.items()):
        checks = []
        for field, (kind, required) in sorted(fields.items()):
            value = F.try_variant_get(arguments, f"$['{field}']", "variant")
            type_name = F.schema_of_variant(value)
            fits = F.lit(False)
            for pattern in TYPES[kind].split("|"):
                fits = fits | type_name.like(pattern)
            checks.append(F.when(value.isNull(), F.lit(f"missing {field}") if required else F.lit(None))
                          .when(~fits, F.lit(f"{field} is not {kind}")))
        present = F.map_keys(F.coalesce(F.from_json(F.to_json(arguments), "map<string,string>"), F.create_map().cast(
            "map<string,string>")))
        extra = F.transform(F.array_sort(F.array_except(present, F.array(*[F.lit(f) for f in sorted(fields)]).cast(
            "array<string>"))), lambda f: F.concat(F.lit("unknown "), f))
        found = F.when(name == tool, F.concat(F.array_compact(F.array(*checks).cast("array<string>")), extra)
                       ).otherwise(found)
    return F.when(~is_object, F.array(F.lit("not an object"))).otherwise(F.coalesce(found, none))


def _reduced(side: DataFrame, name: str) -> DataFrame:
    """Messages an identifier; the side that a hash join keeps in memory, one short row a key."""
    return side.where("call_id is not null").groupBy("conv_id", "call_id").agg(
        F.count("*").alias(f"n_{name}")).hint("shuffle_hash")


def link(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row a call or result, with ``status``, ``errors``, ``sort_place``, ``level`` and canonical ``json``.

    ``calls``: conv_id, place (long), call_id, name, arguments (JSON text), refers_to (an identifier of a call whose
    result the call uses, or null). ``results``: conv_id, place, call_id, content.
    """
    calls = calls.select("conv_id", "place", "call_id", "name", "arguments", "refers_to")
    results = results.select("conv_id", "place", "call_id", "content")
    n_calls, n_results = _reduced(calls, "calls"), _reduced(results, "results")
    key = ["conv_id", "call_id"]
    repeated = (F.coalesce("n_calls", F.lit(0)) > 1) | (F.coalesce("n_results", F.lit(0)) > 1)
    parsed = calls.withColumn("variant", F.try_parse_json("arguments"))
    called = parsed.join(n_results, key, "left").join(n_calls, key, "left").select(
        "conv_id", "place", "call_id", "refers_to", F.lit("call").alias("kind"),
        F.when(repeated, "repeated").when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status"),
        argument_errors(F.col("name"), F.col("variant"), schemas).alias("errors"),
        F.to_json(F.struct(F.lit("assistant").alias("role"), F.array(F.struct(
            F.coalesce("variant", F.to_variant_object(F.array().cast("array<string>"))).alias("arguments"),
            F.col("call_id").alias("id"), "name")).alias("tool_calls"))).alias("json"))
    answered = results.join(n_calls, key, "left").join(n_results, key, "left").select(
        "conv_id", "place", "call_id", F.col("call_id").alias("refers_to"), F.lit("result").alias("kind"),
        F.when(repeated, "repeated").when(F.col("n_calls").isNull(), "orphan").otherwise("linked").alias("status"),
        F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct("content", F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id"))).alias("json"))
    return ordered(called.unionByName(answered))


def ordered(messages: DataFrame) -> DataFrame:
    """Adds ``sort_place`` and ``level``, by which no message comes before the one it refers to."""
    other = F.when(F.col("kind") == "call", "result").otherwise("call")
    named = messages.withColumn("node", F.concat("kind", F.lit(" "), "call_id")).withColumn(
        "to", F.concat(other, F.lit(" "), "refers_to"))
    nodes = named.where("conv_id is not null and node is not null and place is not null").groupBy("conv_id", "node").agg(
        F.min(F.struct("place", "to")).alias("first")).select("conv_id", "node", "first.*")
    if messages.where("kind = 'call' and refers_to is not null").isEmpty():
        # only results refer, and their calls to nothing
        return _placed(named, nodes.select("conv_id", "node", F.col("place").alias("top"), F.lit(0).alias("level")))
    links = stage(_linked(nodes), "chat-links")
    chains, still_open = _chains(links)
    if not still_open:
        return _placed(named, chains)
    circles = _circles(chains.where("next is not null").select("conv_id", "node", "next"))
    chains, _ = _chains(links.join(circles.withColumn("circular", F.lit(True)), ["conv_id", "node"], "left").withColumn(
        "next", F.expr("if(circular, null, next)")).drop("circular"))
    members = links.join(circles, ["conv_id", "node"]).select(
        "conv_id", "node", "place", "to", F.lit(True).alias("circular"))
    found = named.join(members, ["conv_id", "node", "place", "to"], "left")
    return _placed(found.withColumn("status", F.expr("if(circular, 'circular', status)")).withColumn(
        "to", F.expr("if(circular, null, to)")).drop("circular"), chains)


def _linked(nodes: DataFrame) -> DataFrame:
    """Each node with the node it refers to as ``next``, if there is one."""
    known = nodes.select("conv_id", F.col("node").alias("to"), F.col("node").alias("next"))
    return nodes.join(known, ["conv_id", "to"], "left").select("conv_id", "node", "place", "to", "next")


def _chains(links: DataFrame) -> tuple[DataFrame, int]:
    """The latest place on the chain of each node, the last step at which it is reached, and the chains without an end.

    A round joins only the chains that are still open, most of which end in the first rounds. A chain of n nodes contains
    chains of every length below n. So once a round ends no chain, all that are still open lead in circles.
    """
    table = stage(links.select("conv_id", "node", F.col("place").alias("top"), F.lit(0).alias("level"),
                               F.lit(1).alias("steps"), "next"), "chat-chains")
    ended, still_open = table.where("next is null"), table.where("next is not null")
    count, before = still_open.count(), -1
    while count and count != before:
        ahead = ended.unionByName(still_open).select("conv_id", F.col("node").alias("next"), F.struct(
            "top", "level", "steps", F.col("next").alias("next")).alias("ahead"))
        later = F.col("ahead.top") >= F.col("top")
        table = stage(still_open.join(ahead, ["conv_id", "next"]).select(
            "conv_id", "node", F.greatest("top", "ahead.top").alias("top"),
            F.when(later, F.col("steps") + F.col("ahead.level")).otherwise(F.col("level")).alias("level"),
            (F.col("steps") + F.col("ahead.steps")).alias("steps"), F.col("ahead.next").alias("next")), "chat-chains")
        ended, still_open = ended.unionByName(table.where("next is null")), table.where("next is not null")
        before, count = count, still_open.count()
    return ended.unionByName(still_open), count


def _circles(pointers: DataFrame) -> DataFrame:
    """The members of circles, from pointers that all lead in circles: where pointers of any length lead.

    The nodes where longer pointers lead are among those of shorter ones; if none falls out, all of them are members.
    """
    current = stage(pointers, "chat-circles")
    reached, before = current.select("conv_id", "next").distinct().count(), -1
    while reached != before:
        ahead = current.select("conv_id", F.col("node").alias("next"), F.col("next").alias("ahead"))
        after = stage(current.join(ahead, ["conv_id", "next"]).select("conv_id", "node", F.col("ahead").alias("next")),
                      "chat-circles")
        discard(current)
        current, before = after, reached
        reached = current.select("conv_id", "next").distinct().count()
    return current.select("conv_id", F.col("next").alias("node")).distinct()


def _placed(messages: DataFrame, chains: DataFrame) -> DataFrame:
    """Moves each message behind the latest message that it leads to."""
    targets = chains.select("conv_id", F.col("node").alias("to"), F.struct("top", "level").alias("target"))
    late = F.col("target.top") >= F.col("place")
    return messages.join(targets, ["conv_id", "to"], "left").select(
        *[c for c in messages.columns if c not in ("node", "to")],
        F.when(late, F.col("target.top")).otherwise(F.col("place")).alias("sort_place"),
        F.when(late, F.col("target.level") + 1).otherwise(0).cast("int").alias("level"))


def message_json(role: Column, text: Column) -> Column:
    """Canonical JSON of a message that is neither call nor result."""
    return F.to_json(F.struct(text.alias("content"), role.alias("role")))

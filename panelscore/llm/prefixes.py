"""Prefix trie of conversations as a z-fast trie.

A conversation is its turns in order; turns are equal if role and text are. Every prefix has a signature of 122 bits, two
polynomials modulo 2^61 - 1 over digests of its turns, so that prefixes are compared and looked up by one value. Turns are
sorted over all partitions at once and signatures are put together where a conversation crosses partitions: a
conversation may be as long as the table.

The compacted trie is a table: a node stands for an edge of turns (``above``, ``extent``] and for one conversation that
has it. Its handle is the signature at the two-fattest depth of the edge, the one divisible by the largest power of two.
Conversations are inserted in batches. Fat binary search probes two-fattest depths of what is left of a conversation
against the handles and finds its deepest node in as many rounds as its length has bits; the edge below it by the
signature one turn on; the place of exit by comparing with that edge. Edges are then split where conversations leave them, and
the new rest of the batch becomes nodes where it branches or ends. Sums over subtrees are pointer doubling over parents.
At last edges are expanded to a node for each turn.

Equal conversations are inserted once. Joins are on signatures and on (conversation, depth); aggregates combine map-side,
so a first turn that a third of all conversations share is no group of its own anywhere. The one sequential thing is the
digest of the ids that end at a node: ids are joined in blocks of ``BLOCK`` consecutive ones first, and the blocks are
streamed.

Defined results: null role or text counts as empty. Turns are ordered by ``turn``, null first, and equal ones by the digest
of the turn; repeated rows are turns of their own. Rows without a conversation id belong to none and are left out. An
empty table has no rows. Texts are digested whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.llm.common import discard, stage

MODULUS = (1 << 61) - 1
BASES = (1_203_986_171_823_461_923, 2_014_772_399_310_846_271)
BATCHES = 3
BLOCK = 4096
#: Signature of the empty prefix.
ROOT = bytes(16)


def symbols(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """(conv, turn, digest, chars): what the trie reads of each turn."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    return turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), digest.alias("digest"),
        F.char_length(said).cast("long").alias("chars"))


def signed(given: DataFrame) -> DataFrame:
    """(conv, depth, p, prev, chars, c, digest): turns of ``symbols`` in order.

    ``p`` and ``prev`` are the signatures with and without the turn, ``c`` the characters up to and with it.
    """
    ordered = given.repartitionByRange("conv", "turn", "digest").sortWithinPartitions("conv", "turn", "digest")
    hashed = ordered.select("conv", "digest", "chars", *[
        (F.conv(F.substring("digest", at, 15), 16, 10).cast("long") + 1).alias(f"s{k}") for k, at in enumerate((1, 17))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, depth, total, p0, p1, w0, w1 = TaskContext.get().partitionId(), None, 0, 0, 0, 0, 1, 1
        for batch in batches:
            convs, digests, chars, s0, s1 = (batch.column(i).to_pylist() for i in range(5))
            rows = []
            for conv, n, a, b in zip(convs, chars, s0, s1):
                if conv != last:
                    last, depth, total, p0, p1, w0, w1 = conv, 0, 0, 0, 0, 1, 1
                w0, w1 = w0 * BASES[0] % MODULUS, w1 * BASES[1] % MODULUS
                q0, q1, p0, p1 = p0, p1, (p0 + a * w0) % MODULUS, (p1 + b * w1) % MODULUS
                depth, total = depth + 1, total + n
                rows.append((depth, total, p0, p1, q0, q1))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 6)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([part] * len(rows), pa.int32()), *columns],
                names=["conv", "digest", "chars", "part", "depth", "c", "p0", "p1", "q0", "q1"])

    kind = "conv long, digest string, chars long, part int, depth long, c long, p0 long, p1 long, q0 long, q1 long"
    local = stage(hashed.mapInArrow(run, kind), "turns")
    ends = local.groupBy("conv", "part").agg(F.max("depth").alias("n"), F.max("c").alias("c"), *[
        F.max_by(p, "depth").alias(p) for p in ("p0", "p1")])
    crossing = ends.withColumn("parts", F.count("*").over(Window.partitionBy("conv"))).where("parts > 1")

    def added(parts: pd.DataFrame) -> pd.DataFrame:  # as many rows as a conversation has partitions
        rows, n, c, b0, b1 = [], 0, 0, 0, 0
        for r in parts.sort_values("part").itertuples():
            rows.append((r.conv, r.part, n, c, b0, b1))
            b0 = (b0 + pow(BASES[0], n, MODULUS) * int(r.p0)) % MODULUS
            b1 = (b1 + pow(BASES[1], n, MODULUS) * int(r.p1)) % MODULUS
            n, c = n + int(r.n), c + int(r.c)
        return pd.DataFrame(rows, columns=["conv", "part", "n", "chars_before", "b0", "b1"])

    # a partition has two conversations that cross its ends, at most: bounded by the number of partitions
    before = F.broadcast(crossing.groupBy("conv").applyInPandas(
        added, "conv long, part int, n long, chars_before long, b0 long, b1 long"))
    joined = local.join(before, ["conv", "part"], "left")

    def moved(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in (0, 1):
                by = [pow(BASES[k], int(n), MODULUS) for n in f["n"]]
                for name in (f"p{k}", f"q{k}"):
                    f[name] = [(int(b) + w * int(v)) % MODULUS for b, w, v in zip(f[f"b{k}"], by, f[name])]
            yield f.assign(depth=f["depth"] + f["n"], c=f["c"] + f["chars_before"])[
                ["conv", "digest", "chars", "part", "depth", "c", "p0", "p1", "q0", "q1"]]

    def key(name: str) -> Column:
        return F.unhex(F.concat(*[F.lpad(F.hex(f"{name}{k}"), 16, "0") for k in (0, 1)]))

    whole = joined.where("n is null").select(*local.columns).unionByName(
        joined.where("n is not null").mapInPandas(moved, kind))
    return whole.select("conv", "depth", key("p").alias("p"), key("q").alias("prev"), "chars", "c", "digest")


def _fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the largest power of two divides."""
    bits = f"cast(length(bin({low} ^ {high})) - 1 as int)"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _keyed(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Nodes (p, extent, parent, above, conv) with the signatures of their handles and of the first turn of their edges."""
    at = rows.select(F.col("conv"), F.col("depth").alias("at"), F.col("p").alias("found"))
    wanted = nodes.withColumn("handle_at", _fattest("above", "extent"))
    first = at.withColumnsRenamed({"at": "first_at", "found": "first"})
    handle = at.withColumnsRenamed({"at": "handle_at", "found": "handle"})
    return wanted.withColumn("first_at", F.col("above") + 1).join(first, ["conv", "first_at"]).join(
        handle, ["conv", "handle_at"]).select("p", "extent", "parent", "above", "conv", "first", "handle")


def _exits(batch: DataFrame, nodes: DataFrame, rows: DataFrame, bits: int) -> DataFrame:
    """(conv, size, m, pm, edge): where each conversation of a batch leaves the trie.

    ``m`` turns of it are in the trie, ``pm`` is their signature; ``edge`` is the node on whose edge it leaves, null if at a node.
    """
    root = F.lit(ROOT)
    at = rows.select("conv", F.col("depth").alias("at"), F.col("p").alias("found"))
    handles = nodes.select("handle", F.col("p").alias("node"), "extent", "parent", "above")
    state = batch.select("conv", "size", F.lit(0).cast("long").alias("low"), F.col("size").alias("high"),
                         root.alias("p_low"))
    for _ in range(bits):
        open_ = state.where("low < high").withColumn("at", _fattest("low", "high"))
        probed = open_.join(at, ["conv", "at"]).join(handles, F.col("found") == F.col("handle"), "left")
        passed = probed.drop("found").withColumn("end", F.least("extent", "size")).join(
            at.withColumnRenamed("at", "end"), ["conv", "end"], "left")
        through = F.coalesce((F.col("extent") <= F.col("size")) & (F.col("found") == F.col("node")), F.lit(False))
        inside = F.col("node").isNotNull()

        def next_(gone: str, stays: str, missed: Column, then: Column) -> Column:
            return F.when(through, F.col(gone)).when(inside, then).otherwise(missed).alias(stays)

        moved = passed.select(
            "conv", "size", next_("extent", "low", F.col("low"), F.col("above")),
            F.when(through, F.col("high")).when(inside, F.col("above")).otherwise(F.col("at") - 1).alias("high"),
            next_("node", "p_low", F.col("p_low"), F.col("parent")))
        former, state = state, stage(moved.unionByName(state.where("low >= high")), "search")
        if former is not None and _ > 0:
            discard(former)
    edges = nodes.select(F.col("first").alias("found"), F.col("p").alias("edge"), "extent", "above",
                         F.col("conv").alias("rep"))
    below = stage(state.withColumn("at", F.col("low") + 1).join(at, ["conv", "at"], "left").join(edges, "found", "left")
                  .select("conv", "size", "low", "p_low", "edge", "extent", "above", "rep"), "edges-left")
    # the places of the edges that conversations leave, against the turns of these conversations
    left = below.where("edge is not null")
    on_edge = left.select("rep", "above", "extent").distinct()
    places = rows.join(on_edge, rows.conv == on_edge.rep).where("depth > above and depth <= extent").select("p").distinct()
    turns = rows.join(left.select("conv", "above", "extent"), "conv").where("depth > above and depth <= extent")
    shared = turns.join(places, "p", "left_semi").groupBy("conv").agg(
        F.max("depth").alias("shared"), F.max_by("p", "depth").alias("p_shared"))
    return below.join(shared, "conv", "left").select(
        "conv", "size", F.coalesce("shared", "low").alias("m"), F.coalesce("p_shared", "p_low").alias("pm"), "edge")


def build(rows: DataFrame, reps: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The nodes (p, extent, parent, above, conv) of the compacted trie, without the root.

    ``rows`` are the turns of the conversations ``reps`` (conv, size, p), of which no two are equal.
    """
    longest = reps.agg(F.max("size")).first()[0] or 0
    dealt = reps.where("size > 0").withColumn("batch", F.pmod(F.xxhash64("p"), F.lit(batches)))
    nodes = None
    for number in range(batches):
        batch = dealt.where(F.col("batch") == number).select("conv", "size")
        if nodes is None:
            exits = batch.select("conv", "size", F.lit(0).cast("long").alias("m"), F.lit(ROOT).alias("pm"),
                                 F.lit(None).cast("binary").alias("edge"))
        else:
            exits = _exits(batch, nodes, rows, longest.bit_length())
        exits = stage(exits, "exits")
        new = stage(rows.join(exits, "conv").where("depth > m").select("conv", "depth", "p", "prev", "size", "m", "pm"),
                    "new-turns")
        branching = new.groupBy("p").agg(F.first("prev").alias("prev")).groupBy("prev").count().where("count > 1")
        ends = new.where("depth = size").select("p")
        explicit = branching.select(F.col("prev").alias("p")).union(ends).distinct()
        path = Window.partitionBy("conv").orderBy("depth")
        found = new.join(explicit, "p").select(
            "p", "conv", F.col("depth").alias("extent"), F.coalesce(F.lag("p").over(path), "pm").alias("parent"),
            F.coalesce(F.lag("depth").over(path), "m").alias("above"))
        added = found.groupBy("p").agg(F.min_by(F.struct("extent", "parent", "above", "conv"), "conv").alias("n")).select(
            "p", "n.*")
        if nodes is None:
            nodes = stage(_keyed(added, rows), "nodes")
            continue
        splits = exits.where("edge is not null").select("edge", F.col("m").alias("extent"), F.col("pm").alias("p")).distinct()
        split = nodes.withColumnRenamed("p", "edge").join(splits.select("edge").distinct(), "edge", "left_semi")
        points = splits.join(split.select("edge", "parent", "above", "conv"), "edge").unionByName(
            split.select("edge", "extent", F.col("edge").alias("p"), "parent", "above", "conv"))
        along = Window.partitionBy("edge").orderBy("extent")
        chain = points.select("p", "extent", F.coalesce(F.lag("p").over(along), "parent").alias("parent"),
                              F.coalesce(F.lag("extent").over(along), "above").alias("above"), "conv")
        kept = nodes.join(splits.select(F.col("edge").alias("p")).distinct(), "p", "left_anti")
        former, nodes = nodes, stage(kept.unionByName(_keyed(chain.unionByName(added), rows)), "nodes")
        for done in (former, exits, new):
            discard(done)
    return nodes.select("p", "extent", "parent", "above", "conv")


def subtree_sums(nodes: DataFrame, sums: list[str], lows: list[str]) -> DataFrame:
    """``nodes`` (p, parent, ...) with the columns ``sums`` and ``lows`` replaced by sum and minimum over the subtree."""
    state = stage(nodes.select("p", F.col("parent").alias("up"), *sums, *lows), "subtree")
    while not state.where("up is not null").isEmpty():
        added = state.where("up is not null").groupBy(F.col("up").alias("p")).agg(
            *[F.sum(c).alias(f"{c}_below") for c in sums], *[F.min(c).alias(f"{c}_below") for c in lows])
        further = state.where("up is not null").select("p", F.col("up").alias("via")).join(
            state.select(F.col("p").alias("via"), "up"), "via").select("p", "up")
        joined = state.drop("up").join(added, "p", "left").join(further, "p", "left").select(
            "p", "up", *[(F.col(c) + F.coalesce(f"{c}_below", F.lit(0))).alias(c) for c in sums],
            *[F.least(c, f"{c}_below").alias(c) for c in lows])
        former, state = state, stage(joined, "subtree")
        discard(former)
    return nodes.drop(*sums, *lows).join(state.drop("up"), "p")


def digests(ends: DataFrame) -> DataFrame:
    """(p, sha): SHA-256 of the ids of ``ends`` (conv, p) in ascending order, joined by commas."""
    texts = ends.groupBy("p", F.floor(F.col("conv") / BLOCK).alias("block")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("text"))
    blocks = texts.groupBy("p").agg(F.count("*").alias("blocks"), F.first("text").alias("text"))
    single = blocks.where("blocks = 1").select("p", F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    several = texts.join(blocks.where("blocks > 1").select("p"), "p", "left_semi").repartition("p").sortWithinPartitions(
        "p", "block")

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(p, state):
            return pa.RecordBatch.from_pylist([{"p": p, "sha": state.hexdigest()}],
                                              pa.schema([("p", pa.binary()), ("sha", pa.string())]))

        last, state = None, None
        for batch in batches:
            for p, text in zip(batch.column("p").to_pylist(), batch.column("text").to_pylist()):
                if p != last:
                    if last is not None:
                        yield row(last, state)
                    last, state = p, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if last is not None:
            yield row(last, state)

    return single.unionByName(several.select("p", "text").mapInArrow(streamed, "p binary, sha string"))


def trie(turns: DataFrame, convs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The nodes of the trie, one for each distinct prefix of turns, from the root.

    ``turns`` are ``symbols``; ``convs`` (conv) are the distinct ids of all conversations, with turns or without. Columns:
    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes of the
    subtree), saved_tokens (characters of the last texts that members but one repeat, over the subtree), ends_sha256.
    """
    rows = stage(signed(turns), "signed")
    last = rows.groupBy("conv").agg(F.max("depth").alias("size"), F.max_by("p", "depth").alias("p"))
    ends = stage(convs.select(F.col("conv").cast("long")).join(last, "conv", "left").select(
        "conv", F.coalesce("size", F.lit(0)).cast("long").alias("size"), F.coalesce("p", F.lit(ROOT)).alias("p")), "ends")
    reps = stage(ends.groupBy("p").agg(F.min("conv").alias("conv"), F.first("size").alias("size")), "distinct")
    own = stage(rows.join(reps.select("conv"), "conv", "left_semi"), "distinct-turns")
    discard(rows)
    compact = build(own, reps, batches)
    root = convs.limit(1).select(F.lit(ROOT).alias("p"), F.lit(0).cast("long").alias("extent"),
                                 F.lit(None).cast("binary").alias("parent"), F.lit(-1).cast("long").alias("above"),
                                 F.lit(None).cast("long").alias("conv"))
    children = compact.groupBy(F.col("parent").alias("p")).agg(F.count("*").alias("children"))
    ended = ends.groupBy("p").agg(F.count("*").alias("n"), F.min("conv").alias("low"))
    # characters before the edge and at its end
    c_end = own.select("conv", F.col("depth").alias("extent"), F.col("c").alias("c_end"))
    c_from = own.select("conv", (F.col("depth") - 1).alias("above"), (F.col("c") - F.col("chars")).alias("c_from"))
    told = compact.join(c_end, ["conv", "extent"]).join(c_from, ["conv", "above"]).unionByName(
        root.withColumn("c_end", F.lit(0).cast("long")).withColumn("c_from", F.lit(0).cast("long")))
    valued = told.join(children, "p", "left").join(ended, "p", "left").select(
        *told.columns, F.coalesce("children", F.lit(0)).alias("children"), F.coalesce("n", F.lit(0)).alias("n"), "low",
        F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"))
    counted = stage(subtree_sums(valued, ["n", "leaves"], ["low"]), "counted").withColumn(
        "saved", (F.col("n") - 1) * (F.col("c_end") - F.col("c_from")))
    upper = counted.select(F.col("p").alias("parent"), F.col("low").alias("low_above"))
    whole = stage(subtree_sums(counted, ["saved"], []).join(upper, "parent", "left").join(
        digests(ends), "p", "left"), "whole")
    nothing = hashlib.sha256(b"").hexdigest()
    # long edges are expanded in blocks
    spans = whole.where("parent is not null").select("*", F.explode(F.sequence(
        F.floor((F.col("above") + 1) / BLOCK), F.floor(F.col("extent") / BLOCK))).alias("span"))
    each = spans.select("*", F.explode(F.sequence(
        F.greatest(F.col("above") + 1, F.col("span") * BLOCK),
        F.least(F.col("extent"), F.col("span") * BLOCK + BLOCK - 1))).alias("depth"))
    placed = each.join(own.select("conv", "depth", (F.col("c") - F.col("chars")).alias("c_before")), ["conv", "depth"])
    at_end, at_start = F.col("depth") == F.col("extent"), F.col("depth") == F.col("above") + 1
    edges = placed.select(
        F.col("low").alias("conv_id"), "depth", F.when(at_start, F.col("low_above")).otherwise(F.col("low"))
        .alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.when(at_end, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * (F.col("c_before") - F.col("c_from"))).alias("saved_tokens"),
        F.when(at_end, F.coalesce("sha", F.lit(nothing))).otherwise(F.lit(nothing)).alias("ends_sha256"))
    top = whole.where("parent is null").select(
        F.col("low").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(nothing)).alias("ends_sha256"))
    return edges.unionByName(top)


def rebuilt(turns: DataFrame, hundred: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """(turns, convs) for ``trie``: conversations that begin with turns of the first one of their hundred.

    Of conversation c, the first h turns, h = crc32(c) % most, are those of c - c % hundred: all it has if fewer, none if
    there is no such conversation. Its own turns after its first h follow.
    """
    ordered = stage(signed(turns).select("conv", "depth", "digest", "chars"), "ordered")
    convs = stage(turns.select("conv").distinct(), "convs")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    own = ordered.where(F.col("depth") > h).select("conv", (F.col("depth") + most).alias("turn"), "digest", "chars")
    heads = ordered.where((F.col("conv") % hundred == 0) & (F.col("depth") < most)).withColumnRenamed("conv", "base")
    begun = convs.withColumn("base", F.col("conv") - F.col("conv") % hundred).withColumn("h", h).join(heads, "base").where(
        "depth <= h").select("conv", F.col("depth").alias("turn"), "digest", "chars")
    return begun.unionByName(own), convs

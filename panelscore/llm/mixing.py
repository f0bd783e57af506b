"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are counted in words. Sources share ``rate`` times all words by their weights; a target stops at ``repeats`` times
its source, and what exceeds this is shared again among the others. A source is dealt out in blocks of documents: whole
passes over all blocks, then permuted blocks without replacement until the target is reached. The last block is taken
in part: its permuted documents up to the target, and the one document at the edge up to the word where the target ends.
So a source's taken words are its rounded target, and no document is taken more often than ``repeats`` times.

The drawn blocks go to output shards. A binary tree starts with the block counts of all sources; each node gives half
of its blocks to its left child, and how many of each source is a multivariate-hypergeometric draw. The leaves' quotas
are exact: they add up to the sources' counts, and shards differ by a block at most. Shards take disjoint runs of the
permuted blocks, and within a shard rows are ordered by a hash.

Everything depends on hashes of ids and texts alone, so that reruns and lost executors change nothing. A block holds
``BLOCK_DOCS`` documents on average, however many there are. Blocks are ordered in two steps, by the beginning of their
hash and within it, so that a hot source is not one task; the nodes of the splitting tree are dealt over tasks as they
become many. One row a source passes through single windows. Only the one edge block of a source orders its documents.

Defined results: a null or blank text has size 0 and is taken 0 times in words. The null source is a source of its own,
the last in order. If nothing has a word, all targets are 0. Equal rows are dealt out one by one, and so are rows that
repeat an id or have none. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.llm.common import WORD, discard, stage, words

WEIGHTS = (3, 1, 2)
RATE, REPEATS = 1.5, 2
BLOCK_DOCS = 64
#: Words that a shard aims at, and the fewest shards.
SHARD_WORDS, MIN_SHARDS = 10_000_000, 16
#: Levels of the splitting tree after which its nodes are dealt over tasks again, and the most tasks for them.
SPREAD_LEVELS, SPREAD_TASKS = 6, 1024
#: Natural logarithm of the share of a distribution that a draw leaves out at most; draws have steps of 2^-40.
LEFT_OUT = 45.0


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, rate: float = RATE,
                   repeats: int = REPEATS) -> DataFrame:
    """(source, number, docs, source_size, target): one row a source, numbered in order of the source, null last.

    The level of the sharing is the words a unit of weight gets. In order of the level at which sources fill up, it is
    the first one that the sources before it leave for the rest and that the next source doesn't exceed.
    """
    total = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    named = total.withColumn("number", number)
    weight = F.get(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("number") - 1, F.lit(len(weights))))
    shared = named.withColumn("weight", weight).withColumn("top", F.lit(repeats) * F.col("source_size"))
    by_level = Window.orderBy(F.col("top") / F.col("weight"), "number")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    left = (F.lit(rate) * F.sum("source_size").over(everything) - F.coalesce(F.sum("top").over(before), F.lit(0)))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    leveled = shared.withColumn("level", left / rest)
    first = F.min(F.when(F.col("top") / F.col("weight") >= F.col("level"), F.struct(
        (F.col("top") / F.col("weight")).alias("fills"), "number", "level"))).over(everything)["level"]
    return leveled.withColumn("found", first).select(
        "source", "number", "docs", "source_size",
        F.least(F.col("top").cast("double"), F.col("found") * F.col("weight")).alias("target"))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """Marked items among ``drawn`` of ``total`` items, by inversion of the distribution at ``u`` in [0, 1).

    Only values near the mean are gone through: by Hoeffding's bound, 2 exp(-2 t^2 / n) with n draws (or marked items,
    which the distribution is symmetric in), those farther than t away have a share far below the steps of ``u``.
    """
    def bound(value: Column, use) -> Column:  # so that the value is computed once
        return F.element_at(F.transform(F.array(value), use), 1)

    mean = drawn.cast("double") * marked / F.greatest(total, F.lit(1))
    reach = F.sqrt(F.least(marked, drawn) * (LEFT_OUT / 2)) + 1
    low = F.greatest(F.lit(0).cast("long"), drawn - (total - marked), F.floor(mean - reach).cast("long"))
    high = F.least(marked, drawn, F.ceil(mean + reach).cast("long"))

    def found(v: Column) -> Column:
        def step(x: Column) -> Column:  # log p(x) - log p(x - 1)
            up = (v["marked"] - x + 1) * (v["drawn"] - x + 1)
            down = x * (v["total"] - v["marked"] - v["drawn"] + x)
            return F.when(x > v["low"], F.log(up.cast("double")) - F.log(down.cast("double"))).otherwise(F.lit(0.0))

        # the logarithms of p / p(low), from low to high
        logs = F.aggregate(F.sequence(v["low"], v["high"]), F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("most")),
                           lambda s, x: bound(s["p"] + step(x), lambda p: F.struct(
                               p.alias("p"), F.greatest(s["most"], p).alias("most"))))

        def summed(begin: Column, more) -> Column:
            return F.aggregate(F.sequence(v["low"], v["high"]), begin, lambda s, x: bound(
                s["p"] + step(x), lambda p: more(s, x, p)))

        zero = [F.lit(0.0).alias("p"), F.lit(0.0).alias("sum")]

        def quantile(top: Column) -> Column:
            mass = summed(F.struct(*zero), lambda s, x, p: F.struct(
                p.alias("p"), (s["sum"] + F.exp(p - top)).alias("sum")))["sum"]
            return bound(u * mass, lambda want: summed(F.struct(*zero, v["low"].alias("at")), lambda s, x, p: F.struct(
                p.alias("p"), (s["sum"] + F.exp(p - top)).alias("sum"),
                F.when(s["sum"] <= want, x).otherwise(s["at"]).alias("at")))["at"])

        return F.when(v["low"] >= v["high"], v["low"]).otherwise(bound(logs["most"], quantile))

    return bound(F.struct(*[c.alias(n) for c, n in (
        (total, "total"), (marked, "marked"), (drawn, "drawn"), (low, "low"), (high, "high"))]), found)


def split_quotas(quotas: DataFrame, levels: int, seed: str = "split") -> DataFrame:
    """(number, shard, n): blocks of each source in each of 2**levels shards, from (number, n).

    A node of the tree is a row with one entry a source. Within a node, the sources draw one after the other from what
    is left of the node and of its left half.
    """
    kind = "array<struct<number:int,n:bigint,left:bigint>>"
    level = quotas.agg(F.sort_array(F.collect_list(F.struct("number", F.col("n").cast("long").alias("n"))))
                       .alias("parts")).withColumn("node", F.lit(1).cast("long"))
    for depth in range(levels):
        if depth and depth % SPREAD_LEVELS == 0:
            level = level.repartition(min(2 ** depth, SPREAD_TASKS), "node")
        total = F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["n"])
        node = level.withColumn("total", total)
        begin = F.struct(F.col("total").alias("total"), F.shiftright("total", 1).alias("half"),
                         F.array().cast(kind).alias("out"))

        def draw(s: Column, part: Column) -> Column:
            u = F.pmod(F.xxhash64(F.lit(seed), F.lit(depth), F.col("node"), part["number"]),
                       F.lit(1 << 40)) / float(1 << 40)
            drawn = F.array(hypergeometric(s["total"], part["n"], s["half"], u))
            return F.element_at(F.transform(drawn, lambda left: F.struct(
                (s["total"] - part["n"]).alias("total"), (s["half"] - left).alias("half"),
                F.concat(s["out"], F.array(F.struct(part["number"].alias("number"), part["n"].alias("n"),
                                                    left.alias("left")))).alias("out"))), 1)

        drawn = node.select("node", F.aggregate("parts", begin, draw)["out"].alias("out"))
        sides = F.array(
            F.struct((2 * F.col("node")).alias("node"), F.transform("out", lambda p: F.struct(
                p["number"].alias("number"), p["left"].alias("n"))).alias("parts")),
            F.struct((2 * F.col("node") + 1).alias("node"), F.transform("out", lambda p: F.struct(
                p["number"].alias("number"), (p["n"] - p["left"]).alias("n"))).alias("parts")))
        level = drawn.select(F.explode(sides).alias("side")).select("side.node", F.filter(
            "side.parts", lambda p: (p["n"] > 0) | (F.col("side.node") == 1 << depth + 1)).alias("parts"))
    leaves = level.select((F.col("node") - (1 << levels)).cast("int").alias("shard"), F.explode("parts").alias("part"))
    return leaves.select("part.number", "shard", "part.n")


def _digest(doc_id: Column, text: Column, seed: str) -> Column:
    """Rows without an id, and rows that repeat one, differ by their texts."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, text)]
    return F.md5(F.concat_ws(":", F.lit(seed), *parts).cast("binary"))


def _block(digest: Column, blocks: Column) -> Column:
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("long"), blocks)


def _running(rows: DataFrame, turn: str, total: str, *order: str) -> DataFrame:
    """Adds ``before``: the sum of ``total`` over the rows of a number that come before, in order of (turn, *order).

    Rows are added up by the first four digits of ``turn`` first, so that no window holds a whole source.
    """
    cut = rows.withColumn("part", F.substring(turn, 1, 4))
    parts = cut.groupBy("number", "part").agg(F.sum(total).alias("in_part"))
    ahead = Window.partitionBy("number").orderBy("part")
    offsets = parts.select("number", "part", (F.sum("in_part").over(ahead) - F.col("in_part")).alias("offset"))
    inside = Window.partitionBy("number", "part").orderBy(turn, *order)
    summed = cut.withColumn("inside", F.sum(total).over(inside) - F.col(total))
    return summed.join(offsets, ["number", "part"]).withColumn(
        "before", F.col("offset") + F.col("inside")).drop("part", "offset", "inside")


def _placed(sizes: DataFrame, weights: tuple[int, ...], rate: float, repeats: int, block_docs: int,
            seed: str) -> tuple[DataFrame, DataFrame]:
    """Staged tables of the sources, with their blocks, and of the blocks.

    (number, block, passes, open, words, shards): a block is taken ``passes`` times as a whole, and ``open`` words of it
    once more; ``shards`` has the shard of each time.
    """
    sources = stage(source_targets(sizes, weights, rate, repeats).withColumn(
        "blocks", F.ceil(F.col("docs") / block_docs).cast("long")), "mix-sources")
    blocked = _with_source(sizes, sources).withColumn("block", _block(F.col("digest"), F.col("blocks")))
    want = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(0).cast("long")
    blocks = blocked.groupBy("number", "block", "source_size", "target").agg(F.sum("size").alias("words"))
    turn = F.md5(F.concat_ws(":", F.lit(seed), F.col("number"), F.col("block")).cast("binary"))
    # read for the sums as well as for the order
    turned = stage(blocks.withColumn("passes", passes).withColumn(
        "rest", want - F.col("passes") * F.col("source_size")).withColumn("turn", turn), "mix-turns")
    left = F.least(F.greatest(F.col("rest") - F.col("before"), F.lit(0)), F.col("words"))
    opened = _running(turned, "turn", "words", "block").withColumn("open", left)
    placed = stage(opened.select("number", "block", "passes", "open", "words", (
        F.col("passes") + (F.col("open") > 0).cast("long")).alias("draws")), "mix-blocks")
    total = sources.agg(F.sum("target")).first()[0] or 0
    levels = (max(MIN_SHARDS, -(-int(total) // SHARD_WORDS)) - 1).bit_length()
    quotas = split_quotas(placed.groupBy("number").agg(F.sum("draws").alias("n")), levels, seed)
    runs = Window.partitionBy("number").orderBy("shard")
    dealt = quotas.withColumn("end", F.sum("n").over(runs)).where("n > 0").select(
        "number", F.explode(F.sequence(F.col("end") - F.col("n"), F.col("end") - 1)).alias("before"), "shard")
    # every pass goes through the blocks in an order of its own; the draws of a source are numbered through
    each = placed.where("draws > 0").select("number", "block", F.explode(F.sequence(
        F.lit(1).cast("long"), F.col("draws"))).alias("pass"), F.lit(1).cast("long").alias("one"))
    again = F.md5(F.concat_ws(":", F.lit(seed), F.col("number"), F.col("block"), F.col("pass")).cast("binary"))
    numbered = _running(each.withColumn("turn", again), "turn", "one", "block", "pass")
    shards = numbered.join(dealt, ["number", "before"]).groupBy("number", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("dealt"))
    named = F.transform(F.coalesce("dealt", F.array().cast("array<struct<pass:bigint,shard:int>>")),
                        lambda d: d["shard"])
    found = stage(placed.join(shards, ["number", "block"], "left").select(
        "number", "block", "passes", "open", "words", named.alias("shards")), "mix-shards")
    for used in (turned, placed):
        discard(used)
    return sources, found


def _with_source(rows: DataFrame, sources: DataFrame, source: str = "source") -> DataFrame:
    known = sources.select(F.col("source").alias("named"), "number", "source_size", "target", "blocks")
    return rows.join(known, F.col(source).eqNullSafe(F.col("named"))).drop("named")


def _taken(rows: DataFrame) -> DataFrame:
    """Adds ``taken`` and ``times`` to rows (number, block, digest, size) with the columns of their blocks.

    A block is taken as a whole or not at all once more, but for the edge block of a source, whose rows are ordered.
    """
    inner = Window.partitionBy("number", "block").orderBy("digest", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    at_edge = (F.col("open") > 0) & (F.col("open") < F.col("words"))
    whole = rows.where(~at_edge).withColumn("part", F.when(F.col("open") > 0, F.col("size")).otherwise(0))
    edge = rows.where(at_edge).withColumn("inner", F.sum("size").over(inner) - F.col("size")).withColumn(
        "part", F.least(F.greatest(F.col("open") - F.col("inner"), F.lit(0)), F.col("size"))).drop("inner")
    times = F.when(F.col("size") > 0, F.col("passes") + (F.col("part") > 0).cast("long")).otherwise(0).cast("int")
    return whole.unionByName(edge).withColumn(
        "taken", F.col("passes") * F.col("size") + F.col("part")).withColumn("times", times)


def _sizes(docs: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    return stage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words(F.col(text))).cast("long").alias("size"),
        _digest(F.col(doc_id), F.col(text), seed).alias("digest")), "mix-sizes")


def deal(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         weights: tuple[int, ...] = WEIGHTS, rate: float = RATE, repeats: int = REPEATS,
         block_docs: int = BLOCK_DOCS, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, shards): a row for each row of ``docs``.

    ``shards`` has the shard of each time the document is taken; the last one gets ``taken % size`` words if that is
    not 0.
    """
    sizes = _sizes(docs, doc_id, text, source, seed)
    sources, placed = _placed(sizes, weights, rate, repeats, block_docs, seed)
    blocked = _with_source(sizes, sources).withColumn("block", _block(F.col("digest"), F.col("blocks")))
    counted = _taken(blocked.join(placed, ["number", "block"]))
    return counted.select("doc_id", "source", "size", "source_size", "target", "taken",
                          F.slice("shards", F.lit(1), F.col("times")).alias("shards"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, rate: float = RATE, repeats: int = REPEATS, block_docs: int = BLOCK_DOCS,
        seed: str = "mix") -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, dealt out and ordered by shard and hash.

    Columns are those of ``docs``. The text of a source's edge document ends with its last taken word. Each row finds its
    block by its own hash, so that texts are joined to blocks and cross the network for that only where there are more
    blocks than can be broadcast; the rows taken are shuffled to their shards.
    """
    sizes = _sizes(docs, doc_id, text, source, seed)
    sources, placed = _placed(sizes, weights, rate, repeats, block_docs, seed)
    discard(sizes)
    names = [F.col(f"`{c}`") for c in docs.columns]
    carried = docs.select(F.struct(*names).alias("row"), F.col(source).alias("source"),
                          _digest(F.col(doc_id), F.col(text), seed).alias("digest"))
    blocked = _with_source(carried, sources).withColumn("block", _block(F.col("digest"), F.col("blocks")))
    text_of = F.col(f"row.`{text}`")
    # words are counted behind the join, so that the edge blocks do not count those of all texts
    sized = blocked.join(placed, ["number", "block"]).withColumn("size", F.size(words(text_of)).cast("long"))
    each = _taken(sized).select(
        "row", "digest", "times", (F.col("taken") % F.greatest(F.col("size"), F.lit(1))).alias("share"),
        F.posexplode(F.slice("shards", F.lit(1), F.col("times"))).alias("nth", "shard"))
    head = F.array_join(F.slice(F.regexp_extract_all(text_of, F.lit(rf"\s*{WORD}"), F.lit(0)), F.lit(1),
                                F.col("share").cast("int")), "")
    cut = F.when((F.col("nth") == F.col("times") - 1) & (F.col("share") > 0), head).otherwise(text_of).alias(text)
    columns = [cut if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    placed_rows = each.repartition("shard").sortWithinPartitions("shard", F.xxhash64("digest", "nth"))
    return placed_rows.select(*columns)

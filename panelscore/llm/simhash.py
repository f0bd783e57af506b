"""SimHash near-duplicates: 64-bit fingerprints linked by a self-join of binary tries.

A fingerprint summarises the word shingles of a whole text. Two fingerprints link when at most ``BUDGET`` bits differ.
The bits are cut into blocks; of two linked fingerprints at least ``blocks - BUDGET`` blocks are equal. Each choice of
so many blocks gives one trie, whose keys are the fingerprints with these blocks moved to the front. Below a node at the
end of the chosen blocks, pairs of nodes are traversed together from the pair (node, node): a step goes down one bit on
both sides, adds a differing bit to the pair's account, and drops the pair when the account exceeds the budget. So every
link is found in at least one trie, and no pair of documents is ever listed: equal fingerprints are one leaf, and a
task passes on a spanning forest of its links instead of the links.

Scale: the number of blocks, and with it the length of the common front, follows the number of distinct fingerprints. A
node with more leaves than ``NODE_LEAVES`` is dealt out as all pairs of its hash slices, so that no task depends on its
size. Only distinct fingerprints are shuffled, 8 bytes and an id each.

Defined results: null, empty and blank texts have the fingerprint zero and link like any other. Rows with a null id get
a fingerprint but no component, and link to nothing. Rows that repeat an id are copies of one document. Other columns
are neither read nor changed.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from panelscore.llm.common import components, split_words, stage

BITS, BUDGET, SHINGLE, SEED = 64, 4, 4, 42
#: Leaves below one node that one task takes; more are dealt out in slices.
NODE_LEAVES = 20_000
#: Leaves below a node that the length of the common front aims at.
AIM = 64
#: Rows that a task gathers before it traverses, and node pairs that it expands at once.
GATHER, EXPAND = 100_000, 400_000


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles, as a signed long."""
    w = split_words(text)
    if not w:
        return 0
    shingles = map(b" ".join, zip(*(w[i:] for i in range(SHINGLE)))) if len(w) >= SHINGLE else [b" ".join(w)]
    n = max(1, len(w) - SHINGLE + 1)
    h = np.fromiter(map(functools.partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, n, 4096):
        bits = np.unpackbits(h[part:part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter(map(fingerprint, texts), np.int64, len(texts)))


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), _fingerprints(F.col(text)).alias("fp"))


def _bounds(blocks: int) -> list[int]:
    return [BITS * i // blocks for i in range(blocks + 1)]


def block_count(n: int) -> int:
    """The fewest blocks whose common fronts leave about AIM of n random fingerprints below a node."""
    blocks = BUDGET + 1
    while n / 2 ** (BITS * (blocks - BUDGET) // blocks) > AIM and blocks < 16:
        blocks += 1
    return blocks


def _moved(fp: Column, blocks: list[tuple[int, int]]) -> Column:
    """The key with the given bit ranges, the first one highest."""
    key, at = F.lit(0).cast("long"), BITS
    for low, high in blocks:
        at -= high - low
        mask = (1 << (high - low)) - 1
        key = key.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, low).bitwiseAND(F.lit(mask)), at))
    return key


def tries(fingerprints: DataFrame, blocks: int) -> DataFrame:
    """(trie, front, key, id): each fingerprint once a trie, under the node at the end of the chosen blocks."""
    bounds = _bounds(blocks)
    spans = list(zip(bounds, bounds[1:]))
    rows = []
    for t, chosen in enumerate(itertools.combinations(spans, blocks - BUDGET)):
        rest = [s for s in spans if s not in chosen]
        width = sum(h - lo for lo, h in chosen)
        key = _moved(F.col("fp"), [*chosen, *rest])
        rows.append(F.struct(F.lit(t).alias("trie"), F.shiftrightunsigned(key, BITS - width).alias("front"),
                             key.alias("key")))
    return fingerprints.select("id", F.explode(F.array(*rows)).alias("at")).select("at.*", "id")


def _dealt(leaves: DataFrame, node_leaves: int) -> DataFrame:
    """Adds the pair of slices (s, t) that a row belongs to; (0, 0) below nodes that one task takes."""
    large = (leaves.groupBy("trie", "front").agg(F.count("*").alias("n")).where(F.col("n") > node_leaves)
             .select("trie", "front", F.ceil(F.col("n") / node_leaves).cast("int").alias("slices")))
    sliced = leaves.join(large, ["trie", "front"], "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = sliced.withColumn("own", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    other = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return other.select("trie", "front", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"),
                        "key", "id")


class _Forest:
    """Disjoint sets over positions; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            self.root[x] = self.root[up]
            x = up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self._find(a), self._find(b)
            open_ = a != b
            a, b = a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        members = np.arange(len(self.root))
        roots = self._find(members)
        own = roots != members
        return members[own], roots[own]


def join_tries(node: np.ndarray, key: np.ndarray, forest: _Forest, budget: int = BUDGET) -> None:
    """Unites positions of linked keys below the same node. Rows are sorted by node, then by unsigned key."""
    n = len(key)
    ones: dict[int, np.ndarray] = {}

    def below(depth: int) -> np.ndarray:
        if depth not in ones:
            bit = (key >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        return ones[depth]

    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    ends = np.r_[starts[1:], n]
    todo = [(0, starts, ends, starts, ends, np.zeros(len(starts), np.int8))]
    while todo:
        depth, a0, a1, b0, b1, off = todo.pop()
        if len(a0) > EXPAND:  # depth first, so that waiting pairs stay few
            todo += [(depth, *(x[i:i + EXPAND] for x in (a0, a1, b0, b1, off))) for i in range(0, len(a0), EXPAND)]
            continue
        same = a0 == b0
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        i, j = a0[leaf & ~same], b0[leaf & ~same]
        near = np.bitwise_count(key[i] ^ key[j]) <= budget
        forest.unite(i[near], j[near])
        a0, a1, b0, b1, off, same = (x[~leaf] for x in (a0, a1, b0, b1, off, same))
        if depth == BITS:  # equal keys
            forest.unite(np.repeat(a0, b1 - b0), np.concatenate([np.arange(x, y) for x, y in zip(b0, b1)])
                         if len(b0) else b0)
            continue
        c = below(depth)
        a, b = a1 - (c[a1] - c[a0]), b1 - (c[b1] - c[b0])  # where the ones begin
        one, cross = off, off + np.int8(1)
        pairs = [(a0, a, b0, b, one, None), (a, a1, b, b1, one, None), (a0, a, b, b1, cross, None),
                 (a, a1, b0, b, cross, ~same)]  # of a node with itself, the crossing pair counts once
        kept = []
        for x0, x1, y0, y1, d, also in pairs:
            ok = (x1 > x0) & (y1 > y0) & (d <= budget)
            ok = ok if also is None else ok & also
            kept.append([x[ok] for x in (x0, x1, y0, y1, d)])
        merged = [np.concatenate(x) for x in zip(*kept)]
        if len(merged[0]):
            todo.append((depth + 1, *merged))


def _linked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Spanning links of the rows of a partition, which come sorted by node and key."""
    node = ["trie", "front", "s", "t"]

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        key = rows["key"].to_numpy().view(np.uint64)
        number = (rows[node] != rows[node].shift()).any(axis=1).cumsum().to_numpy()
        order = np.lexsort((key, number))
        ids, forest = rows["id"].to_numpy()[order], _Forest(len(rows))
        join_tries(number[order], key[order], forest)
        a, b = forest.links()
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    held: list[pd.DataFrame] = []
    for part in parts:
        held.append(part)
        if sum(map(len, held)) >= GATHER:
            rows = pd.concat(held, ignore_index=True)
            last = (rows[node] == rows[node].iloc[-1]).all(axis=1).to_numpy()
            if not last.all():
                yield links(rows[~last])
            held = [rows[last]]
    if held and sum(map(len, held)):
        yield links(pd.concat(held, ignore_index=True))


def link(fingerprints: DataFrame, node_leaves: int = NODE_LEAVES, blocks: int | None = None) -> DataFrame:
    """(a, b) edges that connect exactly the ids whose fingerprints are linked. Input (id, fp), distinct in fp."""
    blocks = blocks or block_count(fingerprints.count())
    leaves = _dealt(tries(fingerprints, blocks), node_leaves)
    node = ["trie", "front", "s", "t"]
    return (leaves.repartition(*node).sortWithinPartitions(*node, "key").mapInPandas(_linked, "a long, b long"))


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; ids are integers."""
    prints = stage(with_fingerprints(docs, doc_id, text), "simhash")
    nodes = stage(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-nodes")
    groups = components(link(nodes.select("id", "fp")))
    classes = nodes.join(groups.withColumnRenamed("node", "id"), "id", "left").select(
        F.col("fp").alias("class_fp"), F.coalesce("component", "id").alias("component_id"))
    joined = prints.join(classes, prints["fp"] == classes["class_fp"], "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
                         .alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those whose component has a smaller id; rows with a null id stay."""
    gone = cluster(docs, doc_id, text).where("doc_id <> component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(gone, doc_id, "left_anti")

"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased words, joined by single spaces, and an end byte. A byte is eight binary decisions. The context
of a decision is the path of the decisions before it in its byte and the ``DEPTH`` bytes before that byte, nearest
first. Every node of the context tree has a Krichevsky-Trofimov estimate, and the probability of a decision mixes the
estimates of all depths on its path with the weights that context-tree weighting gives them: at each node, an even prior
between its own estimate and the product of its children. A path ends at the deepest node that was seen in training.

Training counts every run of ``DEPTH`` + 1 bytes of every training text, and as the number of different runs grows with
the corpus, so does the model. Runs are counted inside the partitions first. The tree is weighted by parts: below each
context of two bytes in the task that has it, at the two depths above, of at most 65 536 nodes, in the driver. Runs that
occur in scored texts alone take part with count 0, so that each run gets its code length, and scoring is one look-up a
byte. The look-up table goes to the workers in shards of at most ``SHARD_RUNS`` runs; one more scan scores one more shard.

The base is a unigram model. Its counts are joined to the distinct words of each document, hot words by skew-split
partitions.

Defined results: null and empty texts consist of the end token. Without training texts all counts are 0, and each
decision costs one bit. Rows that repeat id and text each get the same result. Null ids are learned from, since their
fold is undefined, only if ``learn`` is true for them. Other columns are neither read nor changed.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.llm.common import discard, split_words, stage

DEPTH = 5
END = b"\n"
SHARD_RUNS = 6_000_000
#: Entries that a task gathers before it passes them on, and bytes it looks up at once.
GATHER_RUNS, GATHER_WORDS, GATHER_ROWS = 4_000_000, 400_000, 300_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def runs_of(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Runs of depth + 1 bytes that end at each byte of the texts, and where each text ends among them."""
    pad = END * depth
    stream = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8).astype(np.uint64)
    n = len(stream) - depth
    runs = np.zeros(max(0, n), np.uint64)
    for k in range(depth + 1):
        runs = (runs << np.uint64(8)) | stream[k:k + n]
    ends = np.cumsum([len(t) for t in texts])
    keep = np.ones(len(runs), bool)
    seams = (ends + depth * np.arange(len(texts)))[:-1]  # the padding of the next text
    for k in range(depth):
        keep[seams + k] = False
    return runs[keep].view(np.int64), ends


def _summed(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, counts = values[order], counts[order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    if counts is None:
        return values[starts], np.diff(np.r_[starts, len(values)])
    return values[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def normal(words: list[bytes]) -> bytes:
    return b" ".join(words) + END


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, word, n) of the texts of a partition; words and counts are of training texts only."""
    words: Counter = Counter()
    held: list[tuple[np.ndarray, np.ndarray]] = []
    schema = pa.schema([("run", pa.int64()), ("word", pa.string()), ("n", pa.int64())])

    def runs() -> pa.RecordBatch:
        values, counts = _summed(np.concatenate([v for v, _ in held]), np.concatenate([c for _, c in held]))
        held[:] = [(values, counts)]
        return pa.record_batch([pa.array(values), pa.nulls(len(values), pa.string()), pa.array(counts)], schema)

    def counted_words() -> pa.RecordBatch:
        batch = pa.record_batch([pa.nulls(len(words), pa.int64()), pa.array(
            [w.decode() for w in words], pa.string()), pa.array(list(words.values()), pa.int64())], schema)
        words.clear()
        return batch

    for batch in batches:
        learn = batch.column("learn").to_pylist()
        split = [split_words(t) for t in batch.column("text").to_pylist()]
        for known in (True, False):
            texts = [normal(w) for w, x in zip(split, learn) if bool(x) == known]
            if texts:
                values, counts = _summed(runs_of(texts)[0])
                held.append((values, counts if known else np.zeros(len(values), np.int64)))
        for w, x in zip(split, learn):
            if x:
                words.update(w)
        if len(words) > GATHER_WORDS:
            yield counted_words()
        if sum(len(v) for v, _ in held) > GATHER_RUNS:
            yield runs()
            held.clear()
    if words:
        yield counted_words()
    if held:
        yield runs()


def _log_gamma_half() -> Callable[[np.ndarray], np.ndarray]:
    """log gamma(n + 1/2) - log gamma(1/2) for counts, by Stirling's series from 16 on."""
    small = np.array([math.lgamma(n + 0.5) - math.lgamma(0.5) for n in range(16)])

    def value(n: np.ndarray) -> np.ndarray:
        x = np.maximum(n, 16) + 0.5
        series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
        return np.where(n < 16, small[np.minimum(n, 15).astype(np.int64)], series - math.lgamma(0.5))
    return value


def _log_factorial(n: np.ndarray) -> np.ndarray:
    small = np.array([math.lgamma(k + 1) for k in range(16)])
    x = np.maximum(n, 16) + 1.0
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return np.where(n < 16, small[np.minimum(n, 15).astype(np.int64)], series)


_half = _log_gamma_half()


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _half(zeros) + _half(ones) - _log_factorial(zeros + ones)


class Level:
    """Nodes of one depth and one place in the byte: counts, own and weighted log probability."""

    def __init__(self, index: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.index, self.zeros, self.ones = index, zeros, ones
        self.own = log_estimate(zeros, ones)
        self.below = below
        self.weighted = self.own if below is None else np.logaddexp(self.own, below) - math.log(2)

    def mixed(self, deeper: np.ndarray) -> np.ndarray:
        """Probability of a one for each row, from that of the depth below; NaN where nothing was seen."""
        zeros, ones = self.zeros[self.index], self.ones[self.index]
        p = np.where(zeros + ones > 0, (ones + 0.5) / (zeros + ones + 1), np.nan)
        if self.below is None:
            return p
        beta = np.exp(np.clip(self.own - self.below, -700, 700))[self.index]
        return np.where(np.isnan(deeper), p, (beta * p + deeper) / (1 + beta))


def subtree(runs: np.ndarray, counts: np.ndarray, place: int, top: int = 2, depth: int = DEPTH) -> list[Level]:
    """Levels from ``depth`` up to ``top`` of the decisions at ``place`` of the byte."""
    byte = runs & 0xFF
    prefix, one = (1 << place) | (byte >> (8 - place)), (byte >> (7 - place)) & 1
    levels: list[Level] = []
    nodes: np.ndarray | None = None
    for d in range(depth, top - 1, -1):
        key = (((runs >> 8) & ((1 << 8 * d) - 1)) << 8) | prefix
        ids, index = np.unique(key, return_inverse=True)
        ones = np.bincount(index, counts * one, len(ids))
        zeros = np.bincount(index, counts, len(ids)) - ones
        below = None
        if levels:
            parent = np.zeros(len(nodes), np.int64)
            parent[levels[-1].index] = index  # every row of a node has the same parent
            below = np.bincount(parent, levels[-1].weighted, len(ids))
        levels.append(Level(index, zeros, ones, below))
        nodes = ids
    return levels


def _gathered(parts: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    frames = [p for p in parts if len(p)]
    if not frames:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows = pd.concat(frames)
    return rows["run"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)


def _tops(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts and weighted log probability of the nodes at depth 2, for the depths above."""
    runs, counts = _gathered(parts)
    for place in range(8 if len(runs) else 0):
        level = subtree(runs, counts, place)[-1]
        rows = np.zeros(len(level.zeros), np.int64)
        rows[level.index] = np.arange(len(runs))
        byte = runs[rows] & 0xFF
        yield pd.DataFrame({"near": (runs[rows] >> 8) & 0xFF, "prefix": (1 << place) | (byte >> (8 - place)),
                            "zeros": level.zeros, "ones": level.ones, "weighted": level.weighted})


class Top:
    """The root and the contexts of one byte: estimates and mixing weights, at most 65 536 of each."""

    def __init__(self, rows: pd.DataFrame):
        shape = (256, 256)
        zeros, ones, below = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        at = (rows["near"].to_numpy(np.int64), rows["prefix"].to_numpy(np.int64))
        zeros[at], ones[at], below[at] = rows["zeros"], rows["ones"], rows["weighted"]
        own = log_estimate(zeros, ones)
        weighted = np.where(zeros + ones > 0, np.logaddexp(own, below) - math.log(2), 0.0)
        self.near = self._node(zeros, ones, own - below)
        zeros, ones, below = zeros.sum(axis=0), ones.sum(axis=0), weighted.sum(axis=0)
        self.root = self._node(zeros, ones, log_estimate(zeros, ones) - below)

    @staticmethod
    def _node(zeros: np.ndarray, ones: np.ndarray, log_beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = np.where(zeros + ones > 0, (ones + 0.5) / (zeros + ones + 1), np.nan)
        return p, np.exp(np.clip(log_beta, -700, 700))

    def mixed(self, near: np.ndarray, prefix: np.ndarray, deeper: np.ndarray) -> np.ndarray:
        for p, beta in ((self.near[0][near, prefix], self.near[1][near, prefix]),
                        (self.root[0][prefix], self.root[1][prefix])):
            deeper = np.where(np.isnan(deeper), p, (beta * p + deeper) / (1 + beta))
        return np.where(np.isnan(deeper), 0.5, deeper)


def _coded(top: Top) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, counts = _gathered(parts)
        total = np.zeros(len(runs))
        for place in range(8 if len(runs) else 0):
            p = np.full(len(runs), np.nan)
            for level in subtree(runs, counts, place):
                p = level.mixed(p)
            byte = runs & 0xFF
            p = top.mixed((runs >> 8) & 0xFF, (1 << place) | (byte >> (8 - place)), p)
            total += np.log10(np.where((byte >> (7 - place)) & 1, p, 1 - p))
        yield pd.DataFrame({"run": runs, "log10": total})
    return run


class Table:
    """Open-addressed look-up of runs in numpy."""

    def __init__(self, runs: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(2 * len(runs)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = size - 1
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.float32)
        slot, left = self._slot(runs), np.arange(len(runs))
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = runs[left[free]]  # of several, the last one stays
            placed = self.keys[slot] == runs[left]
            self.values[slot[placed]] = values[left[placed]]
            slot, left = (slot[~placed] + 1) & self.mask, left[~placed]

    def _slot(self, runs: np.ndarray) -> np.ndarray:
        return ((runs.view(np.uint64) * MULTIPLIER) >> self.shift).view(np.int64)

    def get(self, runs: np.ndarray) -> np.ndarray:
        """Values of the runs; 0 for runs that the table has not."""
        slot = self._slot(runs)
        keys = self.keys[slot]
        found = np.where(keys == runs, self.values[slot], np.float32(0))
        left = np.flatnonzero((keys != runs) & (keys != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            keys = self.keys[slot]
            hit = keys == runs[left]
            found[left[hit]] = self.values[slot[hit]]
            open_ = ~hit & (keys != -1)
            slot, left = slot[open_], left[open_]
        return found


def scores_of(split: list[list[bytes]], table: Table) -> np.ndarray:
    """Log10 probability of each text, from the runs that the table has."""
    result, start = np.zeros(len(split)), 0
    while start < len(split):
        stop, size = start, 0
        while stop < len(split) and (stop == start or size < 2_000_000):
            size += sum(map(len, split[stop])) + len(split[stop]) + 1
            stop += 1
        runs, ends = runs_of([normal(w) for w in split[start:stop]])
        result[start:stop] = np.add.reduceat(table.get(runs).astype(np.float64), np.r_[0, ends[:-1]])
        start = stop
    return result


_tables: dict[str, Table] = {}


def _table_of(shared, name: str) -> Table:
    """One table a worker, built from the broadcast arrays when first needed."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = Table(*shared.value)
    return _tables[name]


class Numbering(dict):
    """Numbers keys in order of their first look-up."""

    def __missing__(self, key: bytes) -> int:
        self[key] = len(self)
        return self[key]


SCORED = "word string, chunk long, packed long, doc_id long, score double"


class Chunk:
    """Rows of some texts, sorted by word, so that they take little space in a shuffle."""

    def __init__(self) -> None:
        self.numbers = Numbering()
        self.codes: list[int] = []
        self.counts: list[int] = []
        self.sizes: list[int] = []
        self.kinds = 0
        self.docs: list[tuple] = []
        self.scores: list[float] = []

    def add(self, doc_id: int | None, mark: int, words: list[bytes], score: float, with_words: bool) -> None:
        counts = Counter(words)
        self.kinds += len(counts)
        if with_words:
            self.codes += map(self.numbers.__getitem__, counts)
            self.counts += counts.values()
        self.sizes.append(len(counts) if with_words else 0)
        self.docs.append((doc_id, mark, len(words)))
        self.scores.append(score)

    def rows(self) -> pa.RecordBatch:
        """(word, chunk, packed, doc_id, score): one for each distinct word of a text, and one, of no word, for the text.

        ``packed`` has the number of the text in its chunk above, and a count of words below. The chunk's number is a
        hash of what is in it; equal chunks have equal texts. Rows of no word have a line break for it, which no word
        contains, and a number that spreads them.
        """
        mark = xxhash.xxh3_64_intdigest(repr(self.docs).encode())
        chunk = mark - (1 << 64) if mark >> 63 else mark
        codes = np.array(self.codes, np.int32)
        number = np.repeat(np.arange(len(self.docs), dtype=np.int64), self.sizes)
        packed = (number << 32) | np.array(self.counts, np.int64)
        order = np.argsort(codes, kind="stable")
        n, k = len(codes), len(self.docs)
        named = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
        ends = pa.array([f"\n{d[1] % 997}" for d in self.docs], pa.string())
        own = [(i << 32) | d[2] for i, d in enumerate(self.docs)]
        columns = {
            "word": pa.concat_arrays([named.take(pa.array(codes[order])), ends]),
            "chunk": pa.array(np.full(n + k, chunk)),
            "packed": pa.array(np.r_[packed[order], np.array(own, np.int64)]),
            "doc_id": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array([d[0] for d in self.docs], pa.int64())]),
            "score": pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(self.scores, pa.float64())])}
        return pa.record_batch(list(columns.values()), list(columns))


def _scored(shared, with_words: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of chunks of texts, with the part of the scores that the runs of the shared table have."""
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table_of(shared, name)
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            split = [split_words(t) for t in batch.column("text").to_pylist()]
            chunk = Chunk()
            for i, mark, w, s in zip(ids, marks, split, scores_of(split, table)):
                chunk.add(i, mark, w, float(s), with_words)
                if chunk.kinds > GATHER_ROWS:
                    yield chunk.rows()
                    chunk = Chunk()
            if chunk.docs:
                yield chunk.rows()
    return run


def train(docs: DataFrame, learn: Column, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(run, log10) code lengths of all runs of ``docs``, and (word, n) counts; learned where ``learn`` holds."""
    counted = stage(docs.select(F.coalesce(learn, F.lit(False)).alias("learn"), F.col(text).alias("text")).mapInArrow(
        _counted, "run long, word string, n long"), "lm-counts")
    words = stage(counted.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    near = F.col("run").bitwiseAND(F.lit(0xFFFF00))
    runs = stage(counted.where("run is not null").groupBy("run").agg(F.sum("n").alias("n")), "lm-runs")
    discard(counted)
    parts = runs.withColumn("near", near).repartition("near").drop("near")
    tops = (parts.mapInPandas(_tops, "near long, prefix long, zeros double, ones double, weighted double")
            .groupBy("near", "prefix").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "weighted")]))
    return stage(parts.mapInPandas(_coded(Top(tops.toPandas())), "run long, log10 double"), "lm-codes"), words


def score(docs: DataFrame, codes: DataFrame, words: DataFrame, ends: int, doc_id: str = "doc_id",
          text: str = "text", shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``ends`` is the number of training texts, each of which has one end token.
    """
    spark = docs.sparkSession
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = total + ends, kinds + (ends > 0)
    n_runs = codes.count()
    shards = max(1, -(-n_runs // shard_runs))
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"),
                        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark"))
    parts = []
    for shard in range(shards):
        own = codes.where(F.pmod(F.xxhash64("run"), F.lit(shards)) == shard).toPandas()
        shared = spark.sparkContext.broadcast((own["run"].to_numpy(np.int64), own["log10"].to_numpy(np.float32)))
        parts.append(named.mapInArrow(_scored(shared, shard == 0), SCORED))
    known = words.select("word", F.col("n").alias("c")).hint("shuffle_hash")
    joined = parts[0].join(known, "word", "left")
    n, c = F.col("packed").bitwiseAND(F.lit(0xFFFFFFFF)), F.coalesce("c", F.lit(0))
    is_word = F.col("score").isNull()
    measured = joined.select(
        "chunk", F.shiftright("packed", 32).alias("nth"), F.when(is_word & (c > 0), n).otherwise(0).alias("k"),
        F.when(is_word, n * F.log10(c + F.lit(1.0))).otherwise(0.0).alias("base"), "doc_id", "score",
        F.when(is_word, 0).otherwise(1).alias("copies"), F.when(is_word, 0).otherwise(n).alias("n"))
    for more in parts[1:]:  # the same chunks, of which only the scores are new
        measured = measured.unionByName(more.select(
            "chunk", F.shiftright("packed", 32).alias("nth"), F.lit(0).cast("long").alias("k"), F.lit(0.0).alias("base"),
            "doc_id", "score", F.lit(0).alias("copies"), n.alias("n")))
    summed = measured.groupBy("chunk", "nth").agg(
        F.max("doc_id").alias("doc_id"), F.max("n").alias("n"), *[F.sum(x).alias(x) for x in ("k", "base", "copies")],
        F.sum("score").alias("score"))
    one = summed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    m, space = F.col("copies"), math.log10(total + kinds + 1)
    based = one.select(
        "chunk", "nth", "copy", "doc_id", (F.col("n") + 1).alias("n_tokens"),
        (F.floor(F.col("k") / m) + int(ends > 0)).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / m + math.log10(ends + 1) - (F.col("n") + 1) * space).alias("base_score"),
        (F.col("score") / m).alias("score"))
    return based.drop("chunk", "nth", "copy")

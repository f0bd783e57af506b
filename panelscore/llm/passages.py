"""Passages that repeat across documents, by compact windows.

The tokens are the hashes of all runs of five words. The Cartesian tree over the hashed tokens of a text gives its compact
windows: all runs of at least ``RUN`` tokens whose minimum is the same token form one window around this token. Two texts
that share such a run share the token at its minimum, whatever surrounds it. The minima are what the search needs; sliding
minima find those of all texts of a batch at once.

1. One scan counts the documents of each window's minimum. A bitmap, of a size bounded by ``MAX_BITS``, keeps the minima
   of two documents or more.
2. One more scan passes on the minima that are in the bitmap, each with the hashes of some blocks of words around it.
   Blocks of ``LONG`` words lie so that any common passage of ``PASSAGE`` words contains one around the minimum of a window
   of ``TOKENS`` tokens. Of the two short blocks around a minimum, any common run of ``RUN`` tokens contains one.
3. Documents with an equal block are linked to the smallest of them, the representative. A block with many documents
   gives a link to each, and no pairs; the smallest id is a map-side combined minimum, and AQE splits the join.
4. The equal blocks of two documents are joined to islands. They are candidates only.
5. Verification: the words of an island and of ``PASSAGE`` words around it are read from both texts and their five-word
   runs aligned. A repeat is an equal run of ``LONG`` words or more, or an interval of ``PASSAGE`` words or more whose
   five-word runs on both sides have a Jaccard similarity of ``SIMILARITY`` or more. What continues an equal run has to
   reach this similarity without it, but for the words that it lacks to a passage.
6. A document whose passage is no repeat of the representative's is held against the other documents of its block, unless
   it is in the representative's class and its words there are a repeat already. The text ``AROUND`` words around a block
   is its context; equal contexts are compared once. Of two that can be similar, ``OVERLAP`` tokens are equal, so they
   share one of the rest if each leaves out its most common ones (the prefix filter), in any run of tokens around the block that
   can hold them. A phrase that many documents have in texts of their own is among those left out, and gives no pairs.
7. The contexts that share a token are held against the smallest of them first: one row a context and token, no pairs.
   Pairs are made of what this leaves open: contexts of different classes, and those whose greater document has no repeat
   there yet. Near copies and texts in one class by another passage give no pairs.

A passage of ``PASSAGE`` words or more that two documents share is always found, and so is every further copy; up to
nine words at its ends may be left out. Changed passages: a change of a word takes five tokens, so an interval with a
similarity of 0.8 and without an equal run of ``LONG`` words has two equal runs beside each other with ``OVERLAP`` tokens
together, one of them with ``RUN``; every such pair of documents shares a short block, and gets into one class. In texts that
repeat a word or two over and over a change may take fewer tokens, and the runs be shorter. Of documents in one class not
all pairs are compared: a document whose words are a repeat already may repeat more of its class.

Defined results: texts with fewer than ``PASSAGE`` words have no windows. Null texts have no words. Rows with a null id
have no class and no links; rows that repeat an id are one document. Repeats within one document don't count. Ids are
integers. Other columns are neither read nor changed.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from panelscore.llm.common import components, discard, session, split_words, stage

SHINGLE, PASSAGE, SIMILARITY = 5, 50, 0.8
TOKENS = PASSAGE - SHINGLE + 1
#: Equal tokens of the least similar passage, at 9 equal tokens for 4 of either side; of these in its longer equal run.
RUN = -(-(-(-4 * 2 * TOKENS // 9)) // 2)
#: Words before and after the minimum's five: long blocks leave a gap of at most ten words to the ends of a passage.
LONG_BLOCKS = ((0, 36), (10, 26), (20, 16), (30, 6), (36, 0))
SHORT_BLOCKS = ((0, RUN // 2), (RUN // 2, 0))
SHORT = RUN // 2 + SHINGLE
LONG = 36 + SHINGLE
#: Equal tokens that any repeat has around a short block: a run of ``LONG`` words has fewer than a changed passage.
OVERLAP = LONG - SHINGLE + 1
#: Words of a context before and after its block: what two equal runs shorter than ``LONG`` and the gap between may reach.
AROUND = 75
#: Runs of a context's tokens that hold two equal runs and up to 5, 6, 8, 10, 12 and 14 other tokens between, and one more than
#: these. What 5 for a shared token and -4 for another sum up to in such a run at least.
RARE = ((42, 6), (46, 7), (52, 9), (62, 11), (72, 13), (82, 15))
LEAST_SHARED = 160
#: By how much the distance of two blocks of an island may differ between the documents, and that of two aligned runs.
SHIFT, DRIFT = 4, PASSAGE // 4
BITS_PER_MINIMUM, MIN_BITS, MAX_BITS = 16, 1 << 20, 1 << 30
GATHER_CHARS = 2_000_000
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(n, base)], dtype=np.uint64)


class Hashed:
    """Word hashes of a text; the hash of any run of words comes from prefix sums."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
        # sums of w[i] / base^i; a run from i to j is (sum[j] - sum[i]) * base^j, so that its place doesn't count
        self.up = _powers(np.uint64(BASE), n)
        self.sums = np.r_[np.uint64(0), np.cumsum(own * _powers(np.uint64(INVERSE), n)[:n], dtype=np.uint64)]

    def runs(self, start: np.ndarray, size: int) -> np.ndarray:
        return _mixed((self.sums[start + size] - self.sums[start]) * self.up[start + size])

    def tokens(self) -> np.ndarray:
        return self.runs(np.arange(len(self.sums) - SHINGLE), SHINGLE)


def compact_windows(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(first, minimum, last) of the Cartesian tree's nodes with at least ``least`` tokens; of equal minima the first."""
    if len(values) > 2000 and len(np.unique(values)) < len(values) // 2:
        return _windows_by_stack(values, least)
    found, todo = [], [(0, len(values))]
    while todo:
        low, high = todo.pop()
        if high - low < least:
            continue
        at = low + int(values[low:high].argmin())
        found.append((low, at, high - 1))
        todo.append((low, at))
        todo.append((at + 1, high))
    return found


def _windows_by_stack(values: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """The same in linear time, for texts that repeat themselves so much that the tree is a list."""
    found, stack = [], []
    for i, v in enumerate([*values.tolist(), -1]):
        while stack and values[stack[-1]] > v:
            at = stack.pop()
            low = stack[-1] + 1 if stack else 0
            if i - low >= least:
                found.append((low, at, i - 1))
        stack.append(i)
    return found


class Batch:
    """The texts of a batch as one stream of words; hashes of runs don't depend on where the runs are."""

    def __init__(self, ids: list, texts: list[str | None]):
        split = [(i, w) for i, t in zip(ids, texts) if len(w := split_words(t)) >= PASSAGE]
        sizes = np.array([len(w) for _, w in split], np.int64)
        self.ids = np.array([i for i, _ in split], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.hashed = Hashed([x for _, w in split for x in w]) if split else None

    def minima(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The windows' documents, the places of their minima, the values of these, and which windows hold ``TOKENS``."""
        values = np.maximum(_mixed(self.hashed.tokens() + np.uint64(0x632BE59BD9B4E019)), np.uint64(1))
        # a run of tokens from a place on is within one document
        left = np.repeat(self.ends - SHINGLE + 1, self.ends - self.starts)[:len(values)] - np.arange(len(values))
        at = np.flatnonzero(_is_minimum(values, left, RUN))
        wide = _is_minimum(values, left, TOKENS)[at]
        return np.searchsorted(self.ends, at, "right"), at, values[at], wide

    def blocks(self, bitmap: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """(hash, document, first word, size) of the blocks around shared minima."""
        if self.hashed is None:
            return
        doc, at, value, wide = self.minima()
        shared = _in_bits(bitmap, value)
        doc, at, value, wide = doc[shared], at[shared], value[shared], wide[shared]
        for before, after in SHORT_BLOCKS + LONG_BLOCKS:
            size = before + SHINGLE + after
            fits = (at - before >= self.starts[doc]) & (at + SHINGLE + after <= self.ends[doc])
            fits &= wide if size == LONG else True
            start = at[fits] - before
            salt = np.uint64(2 * (before * 64 + after) + 1)
            yield _mixed(self.hashed.runs(start, size) + value[fits] * salt), doc[fits], start, size


def _sliding(values: np.ndarray, size: int, pick: Callable) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``size`` values."""
    width = 1
    while 2 * width <= size:
        values, width = pick(values[:-width], values[width:]), 2 * width
    return pick(values[:len(values) - (size - width)], values[size - width:]) if width < size else values


def _is_minimum(values: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """Whether a token is the minimum of a run of ``size`` tokens; ``left`` is how many the document has from there on.

    These are the minima of the compact windows of at least ``size`` tokens.
    """
    if len(values) < size:
        return np.zeros(len(values), bool)
    least = _sliding(values, size, np.minimum)
    least[left[:len(least)] < size] = 0
    around = np.zeros(len(values) + size - 1, np.uint64)
    around[size - 1:size - 1 + len(least)] = least
    return _sliding(around, size, np.maximum) == values


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[Batch]:
    """Streams of bounded length, but of one text at least."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1])
            if size > GATHER_CHARS:
                yield Batch(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield Batch(ids, texts)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Minima of the windows, each once a document."""
    for batch in _batches(batches):
        if batch.hashed is not None:
            doc, _, value, _ = batch.minima()
            order = np.lexsort((doc, value))
            doc, value = doc[order], value[order]
            new = np.r_[True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])][:len(doc)]
            yield pa.record_batch([pa.array(value[new].view(np.int64))], ["minimum"])


def _bits(values: DataFrame) -> np.ndarray:
    """A bitmap of the single column's values, of a size bounded by ``MAX_BITS``."""
    name, bits = values.columns[0], MIN_BITS
    while bits < min(MAX_BITS, BITS_PER_MINIMUM * values.count()):
        bits *= 2
    slot = F.shiftrightunsigned(name, 6).bitwiseAND(F.lit(bits // 64 - 1))
    words = values.groupBy(slot.alias("slot")).agg(F.bit_or(F.expr(
        f"shiftleft(cast(1 as bigint), cast({name} & 63 as int))")).alias("word")).toPandas()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[words["slot"].to_numpy(np.int64)] = words["word"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def _in_bits(bitmap: np.ndarray, value: np.ndarray) -> np.ndarray:
    slot = (value >> np.uint64(6)) & np.uint64(len(bitmap) - 1)
    return ((bitmap[slot.astype(np.int64)] >> (value & np.uint64(63))) & np.uint64(1)) == 1


def _bitmap(docs: DataFrame) -> np.ndarray:
    """Bits of the minima that two documents or more have."""
    counted = docs.mapInArrow(_counted, "minimum long").groupBy("minimum").count()
    minima = stage(counted.where("count > 1").select("minimum"), "passages-minima")
    bitmap = _bits(minima)
    discard(minima)
    return bitmap


def _blocked(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(block, doc, at): ``at`` is twice 64 times the first word, and twice the size, and 1 at a block's first place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            found = list(batch.blocks(shared.value))
            if found:
                key, doc, start = (np.concatenate([x[i] for x in found]) for i in range(3))
                size = np.repeat([x[3] for x in found], [len(x[0]) for x in found])
                order = np.lexsort((start, doc, key))
                key, doc, start, size = key[order], doc[order], start[order], size[order]
                first = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])][:len(key)]
                at = ((start - batch.starts[doc]) << 7) | (size << 1) | first
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(batch.ids[doc]), pa.array(at)],
                                      ["block", "doc", "at"])
    return run


def _aligned(mine: np.ndarray, other: np.ndarray, shift: int) -> np.ndarray:
    """Rows (first, first of the other, size) of equal runs of tokens, both places rising.

    The next run is at the place nearest to the distance of the run before it, and no more than ``DRIFT`` from it.
    """
    places: dict[int, list[int]] = {}
    for j, v in enumerate(other.tolist()):
        places.setdefault(v, []).append(j)
    runs, i, after = [], 0, 0
    values = mine.tolist()
    while i < len(values):
        found = places.get(values[i], [])
        low = bisect_left(found, max(after, i - shift - DRIFT))
        near = found[low:bisect_right(found, i - shift + DRIFT, low)]
        if not near:
            i += 1
            continue
        j = min(near, key=lambda x: abs(i - x - shift))
        size = min(len(values) - i, len(other) - j)
        differs = np.flatnonzero(mine[i:i + size] != other[j:j + size])
        size = int(differs[0]) if len(differs) else size
        runs.append((i, j, size))
        shift, i, after = i - j, i + size, j + size
    return np.array(runs, np.int64).reshape(-1, 3)


def _alike(runs: np.ndarray) -> list[tuple[int, int]]:
    """Intervals of tokens, from one run's start to a later one's end, as long as the similarity allows."""
    if not len(runs):
        return []
    at, of, size = runs.T
    same = np.r_[0, np.cumsum(size)]
    # same / (mine + other - same) >= 4 / 5, as a difference of one value of each end
    ends, starts = 9 * same[1:] - 4 * (at + of + 2 * size), 9 * same[:-1] - 4 * (at + of)
    best = np.maximum.accumulate(ends[::-1])  # rises from the last run to the first
    last = len(runs) - 1 - np.searchsorted(best, starts)
    found = []
    for p, q in enumerate(last.tolist()):
        if q > p and at[q] + size[q] - at[p] >= TOKENS and (not found or at[q] + size[q] > found[-1][1]):
            found.append((int(at[p]), int(at[q] + size[q])))
    return found


def _chained(runs: np.ndarray) -> list[tuple[int, int]]:
    """Similar intervals of tokens, where a long run doesn't make up for what is changed beside it.

    What lies between long runs is judged by itself. It is also a repeat as the continuation of a long run, if it is
    similar by itself or, where it is shorter than a passage, with as much of the long run as makes it one.
    """
    long = np.flatnonzero(runs[:, 2] + SHINGLE - 1 >= LONG).tolist()
    cuts = [-1, *long, len(runs)]
    found = [x for a, b in zip(cuts, cuts[1:]) for x in _alike(runs[a + 1:b])]
    at, of, size = runs.T
    same = np.r_[0, np.cumsum(size)]

    def similar(low: int, of_low: int, high: int, of_high: int, equal: int, most: int) -> bool:
        more = min(max(TOKENS - (high - low), 0), most)
        return 9 * (equal + more) >= 4 * (high - low + of_high - of_low + 2 * more)

    def after(k: int, q: int) -> bool:  # runs k + 1 to q behind the long run k
        return similar(at[k] + size[k], of[k] + size[k], at[q] + size[q], of[q] + size[q], same[q + 1] - same[k + 1],
                       size[k])

    def ahead(p: int, k: int) -> bool:
        return similar(at[p], of[p], at[k], of[k], same[k] - same[p], size[k])

    def between(k: int, n: int) -> bool:
        return similar(at[k] + size[k], of[k] + size[k], at[n], of[n], same[n] - same[k + 1], size[k] + size[n])

    start = None
    for i, k in enumerate(long):
        before, then = cuts[i], cuts[i + 2]
        if start is None:
            start = next((p for p in range(before + 1, k) if ahead(p, k)), k)
        if then < len(runs) and between(k, then):
            continue
        end = next((q for q in range(then - 1, k, -1) if after(k, q)), k)
        if end > start:
            found.append((int(at[start]), int(at[end] + size[end])))
        start = None
    return _outer(found)


def _outer(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The intervals that no other one holds."""
    outer: list[tuple[int, int]] = []
    for a, b in sorted(found, key=lambda x: (x[0], -x[1])):
        if not outer or b > outer[-1][1]:
            outer.append((a, b))
    return outer


def verified(mine: list[bytes], other: list[bytes], shift: int) -> list[tuple[int, int]]:
    """Intervals [start, end) of the words ``mine`` that repeat words of ``other`` with changes.

    ``shift`` is the distance to begin with. Of single equal runs only those shorter than a passage are among the intervals:
    blocks prove the others.
    """
    if min(len(mine), len(other)) < SHINGLE:
        return []
    return _repeated(Hashed(mine).tokens(), Hashed(other).tokens(), shift)


def _can_repeat(own: np.ndarray, others: np.ndarray) -> bool:
    """Whether an interval of ``TOKENS`` tokens or more has four fifths of them among the others, wherever these are."""
    known = np.isin(own, others)
    if len(own) <= TOKENS:
        return bool(known.sum() >= OVERLAP)
    sums = np.r_[0, np.cumsum(np.where(known, 1, -4))]
    return bool((sums[TOKENS:] >= np.minimum.accumulate(sums[:-TOKENS])).any())


def _repeated(own: np.ndarray, others: np.ndarray, shift: int) -> list[tuple[int, int]]:
    """``verified`` for the tokens of both."""
    if not _can_repeat(own, others):
        return []
    runs = _aligned(own, others, shift)
    equal = [(a, a + n) for a, _, n in runs.tolist() if LONG <= n + SHINGLE - 1 < PASSAGE]
    return [(a, b + SHINGLE - 1) for a, b in _outer(_chained(runs) + equal)]


def _only(wanted, name: str = "doc_id") -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows whose id is in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(name).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(_in_bits(wanted.value, _mixed(ids))))
    return run


def _among(rows: DataFrame, ids: DataFrame, name: str = "doc_id") -> DataFrame:
    """The rows whose ``name`` is among the single column of ``ids``, and a few others; nothing is shuffled."""
    wanted = rows.sparkSession.sparkContext.broadcast(_bits(ids.mapInArrow(_hashed_ids, "hash long")))
    return rows.mapInArrow(_only(wanted, name), rows.schema)


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.record_batch([pa.array(_mixed(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))], ["hash"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, low, high, words): the asked runs of words of each text."""
    for batch in batches:
        for doc_id, text, asked in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("asked")):
            words, rows, size = split_words(text.as_py()), [], 0
            for part in asked.as_py():
                rows.append((doc_id, part["low"], part["high"], b" ".join(words[part["low"]:part["high"]])))
                size += len(rows[-1][3])
                if size > GATHER_CHARS:
                    yield _part_rows(rows)
                    rows, size = [], 0
            if rows:
                yield _part_rows(rows)


def _part_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary()
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["id", "low", "high", "words"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    @lru_cache(4000)  # representatives occur over and over
    def tokens(words: bytes) -> np.ndarray:
        split = words.split()
        return Hashed(split).tokens() if len(split) >= SHINGLE else np.zeros(0, np.uint64)

    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("doc", "of", "low", "of_low", "shift"))
        for doc, of, low, of_low, shift, mine, other in zip(*columns, batch.column("mine"), batch.column("other")):
            out += [(doc, of, low + a, low + b) for a, b in _repeated(
                tokens(mine.as_py()), tokens(other.as_py()), shift - low + of_low)]
        if out:
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32()
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["doc", "of", "start", "end"])


def _verify(docs: DataFrame, islands: DataFrame) -> DataFrame:
    """(doc, of, start, end) of the islands (doc, of, low, high, of_low, of_high, shift), by the words of both texts.

    Only documents with islands are shuffled, and each run of words that islands ask for is read once.
    """
    asked = stage(islands.select(F.col("doc").alias("id"), "low", "high").unionByName(islands.select(
        F.col("of").alias("id"), F.col("of_low").alias("low"), F.col("of_high").alias("high"))).groupBy("id").agg(
        F.collect_set(F.struct("low", "high")).alias("asked")), "passages-asked")
    texts = _among(docs, asked.select("id")).join(asked, F.col("doc_id") == F.col("id"))
    # rows that repeat an id and a text give one part
    parts = stage(texts.select("doc_id", "text", "asked").mapInArrow(_parts, "id long, low int, high int, words binary")
                  .repartition("id", "low", "high").distinct(), "passages-parts")
    discard(asked)
    mine = parts.select(F.col("id").alias("doc"), "low", "high", F.col("words").alias("mine"))
    other = parts.select(F.col("id").alias("of"), F.col("low").alias("of_low"), F.col("high").alias("of_high"),
                         F.col("words").alias("other"))
    paired = islands.join(other, ["of", "of_low", "of_high"]).join(mine, ["doc", "low", "high"])
    judged = stage(paired.select("doc", "of", "low", "of_low", "shift", "mine", "other").mapInArrow(
        _judged, "doc long, of long, start int, end int"), "passages-judged")
    discard(parts)
    return judged


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, context, doc, start, failed, lead, tokens): the asked blocks, with the tokens of ``AROUND`` words around them.

    ``lead`` is the number of tokens before the block's.
    """
    kinds = pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.list_(pa.int64())
    names = ["block", "context", "doc", "start", "failed", "lead", "tokens"]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    rows: list[tuple] = []
    for batch in batches:
        for doc, text, asked in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("asked")):
            words = split_words(text.as_py())
            hashed = Hashed(words)
            tokens = hashed.tokens().view(np.int64)
            places = asked.as_py()
            start = np.array([a["start"] for a in places], np.int64)
            low, high = np.maximum(start - AROUND, 0), np.minimum(start + SHORT + AROUND, len(words))
            own = _mixed((hashed.sums[high] - hashed.sums[low]) * hashed.up[high]).view(np.int64)
            for a, i, j, context in zip(places, low.tolist(), high.tolist(), own.tolist()):
                rows.append((a["block"], context, doc, a["start"], a["failed"], a["start"] - i, tokens[i:j - SHINGLE + 1]))
                if len(rows) == 5000:
                    yield batch_of(rows)
                    rows = []
    if rows:
        yield batch_of(rows)


def _rarest(order: np.ndarray, lead: int) -> np.ndarray:
    """Which tokens of a context to compare it by, given a number for each by which all contexts of the block order them.

    Two equal runs beside each other, with the block in one, and ``m`` equal tokens together have at most ``m / 4 - 4`` other
    tokens between them on either side. In a run of tokens around the block that holds these and ``u`` others, the first of
    the equal tokens is among the ``u + 1`` first.
    """
    after = lead + SHORT - SHINGLE + 1
    chosen = np.zeros(len(order), bool)
    for width, first in RARE:
        low, high = max(after - width, 0), min(lead + width, len(order))
        run = order[low:high]
        if len(run) <= width:
            least = np.sort(run)[min(first, len(run)) - 1]
        else:
            ends = np.full(len(run) + width - 1, -1)
            ends[width - 1:len(run)] = np.partition(sliding_window_view(run, width), first - 1, axis=1)[:, first - 1]
            least = _sliding(ends, width, np.maximum)
        chosen[low:high] |= run <= least
    return chosen


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, token, at, failed): the tokens of each context by which it is compared; of tokens that others have as well."""
    for batch in batches:
        size, lead = batch.column("size").to_pylist(), batch.column("lead").to_pylist()
        found = batch.column("found")
        bounds, flat = found.offsets.to_numpy(), found.values
        place, often, token = (flat.field(i).to_numpy() for i in range(3))
        order = (np.minimum(often, 1 << 30) << 32) | (token & 0xFFFFFFFF)
        rows, taken = [], []
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            whole = np.zeros(size[i], np.int64)
            whole[place[a:b]] = order[a:b]
            shared = np.where(whole > 0, 5, -4)
            end = lead[i] + SHORT - SHINGLE + 1
            most = (shared[lead[i]:end].sum() + np.cumsum(shared[:lead[i]][::-1]).max(initial=0)
                    + np.cumsum(shared[end:]).max(initial=0))
            if most < LEAST_SHARED:
                continue
            own = a + np.flatnonzero(_rarest(whole, lead[i])[place[a:b]])
            own = own[np.unique(token[own], return_index=True)[1]]
            rows.append(np.full(len(own), i))
            taken.append(own)
        if rows:
            row, own = pa.array(np.concatenate(rows)), np.concatenate(taken)
            yield pa.record_batch([batch.column("block").take(row), pa.array(token[own]), batch.column("at").take(row),
                                   batch.column("failed").take(row)], ["block", "token", "at", "failed"])


def _others(docs: DataFrame, blocks: DataFrame, linked: DataFrame, islands: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` and the repeats in blocks that a document shares with others than the representative.

    For documents whose island with the representative holds no repeat, as steps 6 and 7 of the module say. The staged
    tables it is given are deleted once they are read.
    """
    core = islands.select("doc", "of", "first", "last").distinct()
    classes = stage(components(found.select(F.col("doc").alias("a"), F.col("of").alias("b")).distinct()), "passages-classes")
    met = core.join(found, ["doc", "of"]).where("start < last and first < end").select("doc", "of", "first", "last").distinct()
    unmet = core.join(met, ["doc", "of", "first", "last"], "left_anti")
    covered = unmet.join(found.select("doc", "start", "end"), "doc").where("start < last and first < end").select(
        "doc", "of", "first", "last").distinct().withColumn("covered", F.lit(True))
    named = unmet.join(covered, ["doc", "of", "first", "last"], "left")
    for end in ("doc", "of"):
        named = named.join(classes.select(F.col("node").alias(end), F.col("component").alias(f"{end}_class")), end, "left")
    open_ = named.where("covered is null or doc_class is null or of_class is null or doc_class <> of_class")
    open_ = stage(open_.select("doc", "of", "first", "last"), "passages-open")
    short = linked.where("block is not null")
    failed = stage(short.join(open_, ["doc", "of"]).where("start >= first and start < last").select(
        "block", "doc").distinct(), "passages-failed")
    for used in (linked, islands, open_):
        discard(used)
    prefix = _prefixes(docs, blocks, failed)
    near = stage(_candidates(prefix.where("failed and low.doc <> at.doc").select(
        F.col("at").alias("one"), F.col("low").alias("two")).distinct()), "passages-nearest")
    first = stage(_verify(docs, _islands(near)).distinct(), "passages")
    classes = stage(components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
        first.select(F.col("doc").alias("a"), F.col("of").alias("b"))).distinct()), "passages-classes")
    # a block within a repeat has nothing to add in its class
    spans = found.select("doc", "start", "end").unionByName(first.select("doc", "start", "end")).distinct()
    ids = prefix.groupBy("block", "at").agg(F.max("failed").alias("failed")).select("block", "at", "failed", F.col("at.doc").alias("id"))
    within = ids.where("failed").join(spans.withColumnRenamed("doc", "id"), "id").where(
        f"start <= at.start and end >= at.start + {SHORT}").select("block", "at").distinct()
    known = ids.join(within.withColumn("within", F.lit(True)), ["block", "at"], "left").join(
        classes.withColumnRenamed("node", "id"), "id", "left").select(
        "block", "at", F.coalesce("component", "id").alias("class"), F.expr("failed and within is null").alias("bare"))
    known = stage(known, "passages-known")
    # blocks of one class whose repeats are all found have nothing left to compare; the same for single tokens
    busy = known.groupBy("block").agg(F.min("class").alias("a"), F.max("class").alias("b"), F.max("bare").alias("any")).where(
        "a <> b or any").select("block")
    rows = stage(prefix.select("block", "token", "at", F.col("at.doc").alias("id")).join(busy, "block").join(
        known, ["block", "at"]), "passages-rows")
    busy = rows.groupBy("block", "token").agg(
        F.min("class").alias("a"), F.max("class").alias("b"), F.max(F.when(F.col("bare"), F.col("id"))).alias("last"),
        F.min("id").alias("low")).where("a <> b or last > low").select("block", "token")
    rows = rows.join(busy, ["block", "token"])
    one, two = rows.alias("one"), rows.alias("two")
    pairs = one.join(two, (F.col("one.block") == F.col("two.block")) & (F.col("one.token") == F.col("two.token")) & (
        F.col("one.id") > F.col("two.id")) & (F.col("one.bare") | (F.col("one.class") != F.col("two.class"))))
    pairs = pairs.select(F.col("one.at").alias("one"), F.col("two.at").alias("two")).distinct()
    # those held against the smallest have been compared
    others = stage(_candidates(pairs).join(near, near.columns, "left_anti"), "passages-others")
    second = _verify(docs, _islands(others))
    whole = stage(found.unionByName(first).unionByName(second).distinct(), "passages")
    for used in (found, failed, prefix, near, first, classes, known, others, second):
        discard(used)
    return whole


def _candidates(pairs: DataFrame) -> DataFrame:
    """(doc, of, start, end, shift) of the pairs (one, two) of contexts' places; ``one`` is in the greater document."""
    return pairs.select(
        F.col("one.doc").alias("doc"), F.col("two.doc").alias("of"), F.col("one.start").alias("start"),
        (F.col("one.start") + SHORT).alias("end"), (F.col("one.start") - F.col("two.start")).alias("shift")).distinct()


def _prefixes(docs: DataFrame, blocks: DataFrame, failed: DataFrame) -> DataFrame:
    """(block, token, at, failed, low): the tokens that contexts are compared by, and the smallest context with the token.

    For the blocks of ``failed`` (block, doc). ``blocks`` is deleted once it is read.
    """
    wanted = failed.select("block").distinct()
    size = F.shiftright("at", 1).bitwiseAND(F.lit(63))
    places = _among(blocks, wanted, "block").where(size == SHORT).select(
        "block", "doc", F.shiftright("at", 7).cast("int").alias("start")).distinct().join(wanted, "block")
    # where a word or a few are repeated over and over, their first block and the last one
    along = Window.partitionBy("block", "doc").orderBy("start")
    inner = (F.col("start") - F.lag("start").over(along) < SHORT) & (F.lead("start").over(along) - F.col("start") < SHORT)
    places = places.withColumn("inner", F.coalesce(inner, F.lit(False))).where("not inner").drop("inner")
    # a block of two places has no others
    several = places.groupBy("block").agg(F.count("*").alias("n")).where("n > 2").select("block")
    places = places.join(several, "block").join(
        failed.withColumn("failed", F.lit(True)), ["block", "doc"], "left")
    asked = stage(places.groupBy(F.col("doc").alias("id")).agg(F.collect_list(F.struct(
        "block", "start", F.coalesce("failed", F.lit(False)).alias("failed"))).alias("asked")), "passages-asked")
    discard(blocks)
    texts = _among(docs, asked.select("id")).join(asked, F.col("doc_id") == F.col("id"))
    seen = texts.select("doc_id", "text", "asked").mapInArrow(
        _contexts, "block long, context long, doc long, start int, failed boolean, lead int, tokens array<long>")
    first = F.struct("doc", "start")
    contexts = stage(seen.groupBy("block", "context").agg(
        F.min(first).alias("at"), F.max("failed").alias("failed"), F.first("lead").alias("lead"),
        F.first("tokens").alias("tokens")), "passages-contexts")
    discard(asked)
    # a row a token is narrow; what else is known of a context is joined to its list of tokens
    contexts = contexts.withColumns({"id": F.xxhash64("at"), "size": F.size("tokens")})
    tokens = contexts.select("block", "id", F.posexplode("tokens").alias("place", "token"))
    often = tokens.withColumn("n", F.count("*").over(Window.partitionBy("block", "token"))).where("n > 1")
    found = often.groupBy("block", "id").agg(F.collect_list(F.struct("place", "n", "token")).alias("found")).join(
        contexts.drop("tokens"), ["block", "id"])
    rare = stage(found.mapInArrow(
        _rare, "block long, token long, at struct<doc:bigint,start:int>, failed boolean"), "passages-rare")
    used = rare.groupBy("block", "token").agg(
        F.count("*").alias("n"), F.max("failed").alias("any"), F.min("at").alias("low")).where("n > 1 and any")
    prefix = stage(rare.join(used.drop("n", "any"), ["block", "token"]), "passages-prefix")
    discard(rare)
    discard(contexts)
    return prefix


def _islands(linked: DataFrame) -> DataFrame:
    """Equal blocks (doc, of, start, end, shift) that lie together: (doc, of, low, high, of_low, of_high, shift, first, last).

    The runs of words to compare, the distance to begin with, and where the blocks are.
    """
    order = Window.partitionBy("doc", "of").orderBy("start", "end", "shift")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    reached = linked.withColumn("reached", F.max("end").over(before)).withColumn(
        "turn", F.lag("shift").over(order))
    broken = (F.col("reached").isNull() | (F.col("start") > F.col("reached") + PASSAGE)
              | (F.abs(F.col("shift") - F.col("turn")) > SHIFT))
    islands = reached.withColumn("island", F.sum(broken.cast("int")).over(order))

    def around(first: Column, last: Column, names: tuple[str, str]) -> tuple[Column, Column]:
        return (F.greatest(F.min(first) - PASSAGE, F.lit(0)).alias(names[0]), (F.max(last) + PASSAGE).alias(names[1]))

    return stage(islands.groupBy("doc", "of", "island").agg(
        *around(F.col("start"), F.col("end"), ("low", "high")),
        *around(F.col("start") - F.col("shift"), F.col("end") - F.col("shift"), ("of_low", "of_high")),
        F.min_by("shift", F.struct("start", "end", "shift")).alias("shift"), F.min("start").alias("first"),
        F.max("end").alias("last")).drop("island").distinct(), "passages-islands")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, of, start, end): words [start, end) of a document repeat a passage of a document with a smaller id.

    A staged table; the tables it is made from are deleted once they are read.
    """
    spark = session(docs.sparkSession)
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(
        "doc_id is not null and text is not null")
    shared = spark.sparkContext.broadcast(_bitmap(named))
    blocks = stage(named.mapInArrow(_blocked(shared), "block long, doc long, at long"), "passages-blocks")
    leads = F.col("at").bitwiseAND(F.lit(1)) == 1
    first = blocks.groupBy("block").agg(
        F.min("doc").alias("of"), F.min_by(F.when(leads, F.col("at")), F.when(leads, F.col("doc"))).alias("of_at"),
        F.max("doc").alias("last")).where("last > of").drop("last")
    size = F.shiftright("at", 1).bitwiseAND(F.lit(63))
    linked = blocks.join(first, "block").where("doc > of").select(
        F.when(size == SHORT, F.col("block")).alias("block"), "doc", "of", F.shiftright("at", 1).alias("at"),
        (F.shiftright("at", 7) - F.shiftright("of_at", 7)).alias("shift"))
    # equal rows meet in the partition that the windows need
    once = linked.repartition("doc", "of").distinct()
    size = F.col("at").bitwiseAND(F.lit(63))
    linked = stage(once.select(
        "block", "doc", "of", F.shiftright("at", 6).cast("int").alias("start"),
        (F.shiftright("at", 6) + size).cast("int").alias("end"), F.col("shift").cast("int").alias("shift")), "passages-links")
    candidates = _islands(linked.drop("block"))
    # blocks at one distance that touch are one equal run; runs that overlap, as in texts that repeat themselves, are one
    equal = _joined(linked, "doc", "of", "shift").where(F.col("end") - F.col("start") >= LONG)
    found = stage(_joined(equal, "doc", "of").unionByName(_verify(named, candidates)).distinct(), "passages")
    return _others(named, blocks, linked, candidates, found)


def _joined(spans: DataFrame, *keys: str) -> DataFrame:
    """(*keys, start, end): the unions of spans of a key that overlap or touch."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = spans.withColumn("first", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    return first.withColumn("run", F.sum("first").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy(
        *keys, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links, repeated_words, passages) of every row of ``docs``.

    A class holds documents that are linked by repeats; its id is the smallest of theirs. ``passages`` has the repeats
    of a document, ``n_links`` counts the documents that they link to, ``repeated_words`` the words that they cover.
    """
    found = repeats(docs, doc_id, text)
    classes = components(found.select(F.col("doc").alias("a"), F.col("of").alias("b")).distinct()).select(
        F.col("node").alias("doc"), F.col("component").alias("class_id"))
    passages = found.groupBy("doc").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "of"))).alias("passages"),
        F.countDistinct("of").alias("n_links"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    joined = rows.join(classes, rows["doc_id"] == classes["doc"], "left").drop("doc").join(
        passages, rows["doc_id"] == passages["doc"], "left")
    none = F.array().cast("array<struct<start:int,end:int,of:bigint>>")
    covered = F.aggregate(F.coalesce("passages", none), F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")),
                          lambda s, p: F.struct(F.greatest(s["at"], p["end"]).alias("at"), (s["n"] + F.greatest(
                              p["end"] - F.greatest(s["at"], p["start"]), F.lit(0))).alias("n")))["n"]
    return joined.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                         F.coalesce("n_links", F.lit(0)).alias("n_links"), covered.alias("repeated_words"),
                         F.coalesce("passages", none).alias("passages"))


def cut_words(text: str, spans: list) -> str:
    """The text without the words of the spans and the white space after them; the rest stays as it is."""
    import re
    at = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, kept = [], 0
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        first, after = at[start][0], at[end][0] if end < len(at) else len(text)
        out.append(text[kept:max(kept, first)])
        kept = max(kept, after)
    return "".join(out) + text[kept:]


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each repeated passage left only where its id is smallest; documents left without words go."""
    found = repeats(docs, doc_id, text)
    # names that no column of the input has
    spans = found.groupBy(F.col("doc").alias("__doc")).agg(F.collect_set(F.struct("start", "end")).alias("__spans"))
    wanted = docs.sparkSession.sparkContext.broadcast(_bits(found.select("doc").distinct().mapInArrow(
        _hashed_ids, "hash long")))

    def asked(ids: pd.Series) -> pd.Series:
        return pd.Series(_in_bits(wanted.value, _mixed(ids.to_numpy(np.int64).view(np.uint64))))

    asked.__annotations__ = {"ids": pd.Series, "return": pd.Series}

    def run(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([cut_words(t, s) for t, s in zip(texts, lists)])

    run.__annotations__ = {"texts": pd.Series, "lists": pd.Series, "return": pd.Series}
    names = [F.col(f"`{c}`") for c in docs.columns]
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    # the bitmap lets a few documents without spans through; all others are not shuffled
    number = F.col(doc_id).cast("long")  # where it is missing, a null column of whole numbers would be one of floats
    marked = docs.withColumn("__asked", number.isNotNull() & F.pandas_udf(asked, BooleanType())(
        F.coalesce(number, F.lit(0).cast("long"))))
    joined = marked.where("__asked").join(spans, F.col(doc_id) == F.col("__doc"), "left")
    whole = marked.where("not __asked").select(*names).unionByName(joined.where("__spans is null").select(*names))
    cut = joined.where("__spans is not null").select(
        *others, F.pandas_udf(run, StringType())(F.col(text), F.col("__spans")).alias(text))
    return whole.unionByName(cut.where(F.col(text).rlike(r"[^\x20\x09-\x0D]")).select(*names))

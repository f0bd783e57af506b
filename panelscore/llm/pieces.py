"""SentencePiece encoding and decoding of whole texts with a given BPE model, by suffix-array matching.

A text is its units: it is cut before every space, and where two characters meet that no piece has side by side. No piece
crosses from one unit into the next, so a unit is encoded once a worker and looked up from then on. The new units of an
Arrow batch are joined to one text. Its suffix array, sorted by as many
characters as the longest piece has, by doubling, is searched for every piece of the model: the range of
suffixes that begin with a piece are its occurrences. These edges, sorted by where they end, are relaxed from left to
right: of the pieces that end at a place, the one is taken that the model would leave unmerged beside the last piece of
the text before it. For byte-pair merges this gives exactly the model's own encoding, and one piece at each place.
Whether two pieces stay unmerged is found for many pairs at once, from the last merges of each: the pieces that have been
at its end, or its beginning, on the way from its characters are followed back in the order of their scores.

The model file is read by the driver, and its pieces are broadcast: their number is that of the vocabulary.

Defined results: null gives null, the empty text no ids. Characters without a piece are encoded as bytes. Decoding the
ids gives the text again, except that U+2581 becomes a space, as in the model's own library. Memory is bounded by the
batch and twice ``KNOWN`` units. Other columns of the input are kept.
"""

from __future__ import annotations

import functools
import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
KNOWN = 200_000
#: Characters of a batch that are cut into units at once, and of new units that are encoded at once.
SPLIT = 1_000_000
LEARNT = 100_000
NEVER = float("-inf")
IDS = np.dtype("<i4")
Vocabulary = tuple[tuple[str, float, int], ...]


def read_model(path: str = MODEL) -> Vocabulary:
    """(piece, score, kind) in order of the ids; kind is 0, or 1 for a byte, or 2 for control and unknown pieces."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = [1 if model.is_byte(i) else 2 if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else 0
             for i in range(model.get_piece_size())]
    found = tuple((model.id_to_piece(i), model.get_score(i), k) for i, k in enumerate(kinds))
    if any(SPACE in p.lstrip(SPACE) for p, _, k in found if k == 0):
        raise ValueError("the model has pieces that go on after a space")
    return found


def _scattered(pairs: np.ndarray) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64)


class Coder:
    def __init__(self, vocabulary: Vocabulary):
        self.ids = {p: i for i, (p, _, k) in enumerate(vocabulary) if k == 0}
        self.score = {p: s for p, s, k in vocabulary if k == 0}
        self.byte = {int(p[3:-1], 16): i for i, (p, _, k) in enumerate(vocabulary) if k == 1}
        self.raw = [bytes([int(p[3:-1], 16)]) if k == 1 else p.replace(SPACE, " ").encode() if k == 0 else b""
                    for p, _, k in vocabulary]
        self.longest = max(map(len, self.ids))
        symbols = sorted(set("".join(self.ids)))
        #: 0 ends a unit, 1 is any character that no piece has
        self.symbol = np.ones(0x110000, ">u2")
        self.symbol[[ord(c) for c in symbols]] = np.arange(2, len(symbols) + 2)
        # a piece that its own characters don't merge to never occurs; the others by falling score
        halves = {p: self.merged(p, 2) for p in self.ids}
        self.pieces = sorted((p for p, h in halves.items() if "".join(h) == p and len(h) <= 2),
                             key=self.score.__getitem__, reverse=True)
        self.numbers = [self.ids[p] for p in self.pieces]
        self.number_at = np.array([*self.numbers, 0, 0], IDS)  # none at -1 and -2
        width = max(map(len, self.pieces))
        keys = np.zeros((len(self.pieces), width), ">u2")
        ends = np.full((len(self.pieces), width), 0xFFFF, ">u2")
        for row, p in enumerate(self.pieces):
            keys[row, :len(p)] = ends[row, :len(p)] = self.symbol[[ord(c) for c in p]]
        self.low, self.high = self._sorted(self._strings(keys)), self._sorted(self._strings(ends))
        #: Whether a piece has the two symbols side by side; not for spaces, whose runs are merged on their own.
        self.beside = np.zeros((len(symbols) + 2, len(symbols) + 2), bool)
        for p in self.ids:
            at = self.symbol[[ord(c) for c in p]]
            self.beside[at[:-1], at[1:]] = True
        self.lengths = np.array([len(p) for p in self.pieces], np.int32)
        self._joins([halves[p] for p in self.pieces])
        # pairs by a hash of theirs, for looking up many at once
        self.pair_keys, self.pair_apart = np.full(1 << 20, -1), np.zeros(1 << 20, np.int8)
        self.beside[:, self.symbol[ord(SPACE)]] = False
        # ids of units as bytes, four each
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _sorted(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(strings)
        return strings[order], order

    @staticmethod
    def _strings(rows: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(rows).view(f"S{2 * rows.shape[1]}").ravel()

    def _joins(self, halves: list[list[str]]) -> None:
        """The last merge of each piece, and what any two pieces make together, by number: a smaller one merges first."""
        number = {p: i for i, p in enumerate(self.pieces)}
        scores = [self.score[p] for p in self.pieces]
        #: Pieces of one score merge from the left, whichever they are.
        self.rank = np.searchsorted(-np.array(scores), -np.array(scores), "left")
        self.begins = np.array([number[h[0]] if len(h) == 2 else -1 for h in halves])
        self.ends = np.array([number[h[1]] if len(h) == 2 else -1 for h in halves])
        pairs = [(number[a] * len(number) + number[b], self.score[p]) for p in self.ids for k in range(1, len(p))
                 if (a := p[:k]) in number and (b := p[k:]) in number]
        pairs.sort()
        self.join_keys = np.array([k for k, _ in pairs] or [-1])
        self.join_rank = np.searchsorted(-np.array(scores), -np.array([s for _, s in pairs] or [0.0]), "left")

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Merges neighbours into pieces, the best score first, of equal ones the leftmost, until ``least`` are left."""
        if len(text) > 40 and least == 1:
            return self._merged_by_queue(text)
        part, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in zip(part, part[1:])]
        while len(scores) >= least and (best := max(scores)) > NEVER:
            i = scores.index(best)
            part[i:i + 2] = [part[i] + part[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = score(part[i] + part[i + 1], NEVER)
            if i:
                scores[i - 1] = score(part[i - 1] + part[i], NEVER)
        return part

    def _merged_by_queue(self, text: str) -> list[str]:
        """The same for long texts."""
        part: list[str | None] = list(text)
        after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(part) and (s := self.score.get(part[i] + part[after[i]])) is not None:
                heapq.heappush(queue, (-s, i, part[i] + part[after[i]]))

        for i in range(len(part) - 1):
            offer(i)
        while queue:
            _, i, whole = heapq.heappop(queue)
            if part[i] is None or after[i] >= len(part) or part[i] + part[after[i]] != whole:
                continue
            gone = after[i]
            part[i], part[gone], after[i] = whole, None, after[gone]
            if after[i] < len(part):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p is not None]

    def unmerged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether pairs of pieces, by number, stay apart.

        The merge made last, on the left or on the right, is taken back, the right one of equals. What then meets at the
        boundary has merged if its score comes before that merge; on the right also if it is equal, since it is further left.
        """
        apart = np.ones(len(left), bool)
        which = np.arange(len(left))
        until = np.full(len(left), np.iinfo(np.int64).max)
        while len(which):
            pair = left * len(self.pieces) + right
            at = np.minimum(np.searchsorted(self.join_keys, pair), len(self.join_keys) - 1)
            joins = (self.join_keys[at] == pair) & (self.join_rank[at] < until)
            apart[which[joins]] = False
            first, last = self.ends[left], self.begins[right]  # what they were made of at the boundary
            on_left = (first >= 0) & ((last < 0) | (self.rank[left] > self.rank[right]))
            until = np.where(on_left, self.rank[left], self.rank[right] + 1)
            on = ~joins & ((first >= 0) | (last >= 0))
            left, right = np.where(on_left, first, left)[on], np.where(on_left, right, last)[on]
            which, until = which[on], until[on]
        return apart

    def _symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]

    def _suffixes(self, symbols: np.ndarray) -> np.ndarray:
        """The suffix array, by ``longest`` symbols or more: ranks by four symbols, then by twice as many each time."""
        width, size = 4, len(symbols)
        rank = np.zeros(size + 4, np.uint64)
        rank[:size] = symbols
        key = rank[:size] << np.uint64(48)
        for k in (1, 2, 3):
            key |= rank[k:size + k] << np.uint64(48 - 16 * k)
        while True:
            order = np.argsort(key)
            if width >= self.longest:
                return order
            ordered = key[order]
            ranks = np.zeros(size + width, np.uint64)  # beyond the end
            ranks[order] = np.cumsum(np.r_[True, ordered[1:] != ordered[:-1]][:size]).astype(np.uint64)
            key = (ranks[:size] << np.uint64(32)) | ranks[width:]
            width *= 2

    def edges(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(end, piece number) of all occurrences of pieces in the text, by end and then length."""
        symbols = self._symbols(text)
        padded = np.r_[symbols, np.zeros(self.longest, ">u2")].astype(">u2")
        windows = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[:len(symbols)]
        order = self._suffixes(symbols).astype(np.int32)
        ordered = self._strings(windows[order])
        first, count = np.empty(len(self.pieces), np.int64), np.empty(len(self.pieces), np.int64)
        first[self.low[1]] = np.searchsorted(ordered, self.low[0], "left")
        count[self.high[1]] = np.searchsorted(ordered, self.high[0], "right")
        count -= first
        piece = np.repeat(np.arange(len(count), dtype=np.int32), count)
        start = order[np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
        end = start + self.lengths[piece]
        by_end = np.argsort(end.astype(np.int64) * (self.longest + 1) - self.lengths[piece])  # no two of an end have one length
        return end[by_end], piece[by_end]

    def learn(self, words: list[str]) -> None:
        """Encodes the words, with a space in front of each, and keeps the ids of their units."""
        self.encode(words)

    def _learnt(self, units: list[str]) -> list[bytes]:
        out: list[bytes] = []
        at = 0
        while at < len(units):
            size, first = 0, at
            while at < len(units) and size < LEARNT:
                size, at = size + len(units[at]), at + 1
            some = units[first:at]
            text = "\0".join(some)
            lengths = np.array([len(u) + 1 for u in some])
            begins = np.cumsum(lengths) - lengths
            last, origin = self._relaxed(text, begins)
            out += self._paths(text, begins, begins + lengths - 1, last, origin)
        return out

    def _ids_of(self, units: list[str]) -> list[bytes]:
        found = list(map(self.known.get, units))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = {units[i] for i in missing}
        again = {u: self.older[u] for u in new & self.older.keys()}
        if len(self.known) + len(new) > KNOWN:  # units of the batches before this half stay known once more
            self.known, self.older = {}, self.known
        fresh = list(new.difference(again))
        again.update(zip(fresh, self._learnt(fresh)))
        for i in missing:
            found[i] = again[units[i]]
        if len(again) <= KNOWN:
            self.known.update(again)
        return found

    def _paths(self, text: str, begins: np.ndarray, ends: np.ndarray, last: np.ndarray,
               origin: np.ndarray) -> list[bytes]:
        """Ids of the units, from their ends back to their beginnings, a piece of every unit at a time."""
        units, taken = [], []
        unit, at = np.arange(len(begins)), ends
        while len(unit):
            open_ = at > begins[unit]
            unit, at = unit[open_], at[open_]
            units.append(unit)
            taken.append(last[at])
            at = origin[at]
        unit, piece = np.concatenate(units[::-1]), np.concatenate(taken[::-1])  # of a unit in the order of the text
        data = self.number_at[piece[np.argsort(unit, kind="stable")]].tobytes()
        bounds = np.r_[0, 4 * np.cumsum(np.bincount(unit, minlength=len(begins)))].tolist()
        found = [data[a:b] for a, b in zip(bounds, bounds[1:])]
        for i in np.unique(unit[piece == -1]).tolist():  # with characters written as bytes
            found[i] = self._ids(text, int(begins[i]), int(ends[i]), last, origin)
        return found

    def _relaxed(self, text: str, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last piece up to each place, -1 for a character without one, and where it begins.

        Edges are taken by their distance from the beginning of their unit, all units side by side, and the longer ones
        of a place first.
        """
        end, piece = self.edges(text)
        start = end - self.lengths[piece]
        begin = begins[np.searchsorted(begins, start, "right") - 1]
        distance = end - begin
        first = np.flatnonzero(np.r_[True, end[1:] != end[:-1]][:len(end)])
        rank = np.arange(len(end)) - np.repeat(first, np.diff(np.r_[first, len(end)]))
        turn = distance * self.longest + rank  # a place has at most one piece of each length
        order = np.argsort(turn)
        step = np.r_[True, np.diff(turn[order]) != 0][:len(order)]
        bounds = np.r_[np.flatnonzero(step), len(order)].tolist()
        last, origin = np.full(len(text) + 1, -1), np.arange(-1, len(text))
        for low, high in zip(bounds, bounds[1:]):
            edge = order[low:high]
            edge = edge[last[end[edge]] < 0]
            before = last[start[edge]]
            apart = (before < 0) | self.apart(before * len(self.pieces) + piece[edge], before >= 0)
            edge = edge[apart]
            last[end[edge]], origin[end[edge]] = piece[edge], start[edge]
        return last, origin

    def apart(self, pairs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Whether the pairs of pieces stay unmerged, each found once; False where it is not wanted."""
        slots = self.pair_keys.size - 1
        slot = _scattered(pairs) & slots
        found = np.where(wanted & (self.pair_keys[slot] == pairs), self.pair_apart[slot], np.int8(-1))
        left = np.flatnonzero(wanted & (found < 0))
        if len(left):
            kinds, index = np.unique(pairs[left], return_inverse=True)
            values = self.unmerged(*np.divmod(kinds, len(self.pieces))).astype(np.int8)
            found[left] = values[index]
            at = _scattered(kinds) & slots  # of pairs with the same slot, the last one stays
            self.pair_keys[at] = kinds
            self.pair_apart[at] = values
            kept = self.pair_keys[at] == kinds
            self.pair_apart[at[kept]] = values[kept]
        return found == 1

    def _ids(self, text: str, begin: int, end: int, last: np.ndarray, origin: np.ndarray) -> bytes:
        found: list[int] = []
        while end > begin:
            if last[end] >= 0:
                found.append(self.numbers[last[end]])
            else:
                found += [self.byte[b] for b in reversed(text[end - 1].encode())]
            end = int(origin[end])
        return np.array(found[::-1], IDS).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        """For each text its ids, as bytes."""
        out: list[bytes | None] = []
        some, size = [], 0
        for t in texts:
            some.append(t)
            size += len(t or "")
            if size > SPLIT:
                out += self._encoded(some)
                some, size = [], 0
        return out + self._encoded(some)

    def _encoded(self, texts: list[str | None]) -> list[bytes | None]:
        spaced = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        whole = "\0".join(spaced)
        lengths = np.array([len(t) + 1 for t in spaced])
        begins = np.cumsum(lengths) - lengths
        starts = self._cuts(whole)
        units = [whole[a:b] for a, b in itertools.pairwise(starts.tolist())]
        ids = self._ids_of(units)
        first = np.searchsorted(starts, begins).tolist()
        last = np.searchsorted(starts, begins + lengths - 1).tolist()  # of the zero after the text, or the end
        return [None if t is None else b"".join(
            self._spaced(units[a:b], ids[a:b]) if SPACE * 2 in s or s[-1:] == SPACE else ids[a:b])
            for t, s, a, b in zip(texts, spaced, first, last)]

    def _cuts(self, text: str) -> np.ndarray:
        """Where the units of a text begin, and its end."""
        symbols = self._symbols(text)
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = ~self.beside[symbols[:-1], symbols[1:]]
        return np.flatnonzero(cut)

    def _spaced(self, units: list[str], ids: list[bytes]) -> list[bytes]:
        """Ids of a text with runs of spaces, which merge after everything else."""
        space = self._run(1)
        out, n = [], 0
        for unit, found in zip(units, ids):
            if unit == SPACE:
                n += 1
                continue
            if n and unit[0] == SPACE and found[:4] == space:
                n, found = n + 1, found[4:]
            if n:
                out.append(self._run(n))
            out.append(found)
            n = 0
        return out + [self._run(n)] if n else out

    def _run(self, n: int) -> bytes:
        return np.array([self.ids[p] for p in self.merged(SPACE * n)], IDS).tobytes()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ")


_coders: dict[str, Coder] = {}


def _coder(shared, model: str) -> Coder:
    """One coder a worker, for the model file named."""
    if model not in _coders:
        _coders.clear()
        _coders[model] = Coder(shared.value)
    return _coders[model]


@functools.lru_cache(4)
def _read(path: str) -> Vocabulary:
    return read_model(path)


def encoder(spark: SparkSession, model: str = MODEL):
    """A function from a column of texts to a column of ids."""
    shared = spark.sparkContext.broadcast(_read(model))

    def run(texts: pa.Array) -> pa.Array:
        rows = _coder(shared, model).encode(texts.to_pylist())
        flat = np.frombuffer(b"".join(r for r in rows if r), IDS)
        sizes = np.array([len(r) // 4 if r else 0 for r in rows], np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        none = pa.array([r is None for r in rows], pa.bool_())
        return pa.ListArray.from_arrays(offsets, pa.array(flat), mask=none)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, ArrayType(IntegerType()))


def decoder(spark: SparkSession, model: str = MODEL):
    """A function from a column of ids to a column of texts."""
    shared = spark.sparkContext.broadcast(_read(model))

    def run(ids: pa.Array) -> pa.Array:
        coder, offsets, flat = _coder(shared, model), ids.offsets.to_pylist(), ids.values.to_numpy(zero_copy_only=False)
        valid = ids.is_valid().to_pylist()
        return pa.array([coder.decode(flat[a:b].tolist()) if v else None
                         for v, a, b in zip(valid, offsets, offsets[1:])], pa.string())

    run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, StringType())


def encoded(docs: DataFrame, text: str = "text", model: str = MODEL) -> DataFrame:
    """Adds ``ids``, ``n_tokens`` and ``round_trip``: whether decoding the ids gives the text again."""
    ids: Column = encoder(docs.sparkSession, model)(F.col(text))
    back: Column = decoder(docs.sparkSession, model)(F.col("ids"))
    named = docs.withColumn("ids", ids)
    return named.withColumn("n_tokens", F.coalesce(F.size("ids"), F.lit(0)).cast("long")).withColumn(
        "round_trip", back == F.col(text))

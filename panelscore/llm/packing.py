"""Packing documents into sequences of bounded length by vector best-fit.

A document is its token ids and one end id; a longer one than a sequence is cut into pieces of the sequence's length.
Sequences have three capacities: tokens, pieces (documents) and attention cost, the sum of squared piece lengths. Pieces
are taken in order of falling weighted size. Each goes to the open sequence that has room for it in every dimension and
that the rule prefers: the least weighted norm of what would be left (``norm``), or the largest weighted dot product of
the piece with what is free (``dot``); a new sequence is begun only if none has room.

Tokens: no token crosses white space, so a word is encoded once a worker and looked up from then on. Packing reads
lengths, not ids: pieces are dealt by a hash of their place in a staged table into groups of ``GROUP`` pieces at most on
average, however often an id or a text repeats. A group is packed as a whole; its bound is the memory a task needs. What
is in sequences filled below ``FULL`` is then packed once more, in groups of its own, so that a group costs no
half-empty sequence.

Defined results: a null or empty text is the end id alone. Repeated rows are packed one by one. An empty table gives no
rows. Null ids are kept. The result has the columns of ``pieces`` and the place; other columns of the documents are not
carried. Long texts are read in parts; a part is at most ``PART`` bytes and the word at its end.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from panelscore.llm.common import stage

TOKENS = 4096
END_ID = 1
GROUP = 8192
#: Sequences filled to this share of their tokens are closed after the first round.
FULL = 0.97
#: Words a worker remembers in each of two generations, the longest of them in bytes, and the bytes read or returned at once.
KNOWN, KNOWN_BYTES, PART = 300_000, 128, 4 << 20
SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Words that canonical composition leaves as they are, and whose letters have a lower case of their own.
LATIN = re.compile("[!-~À-ÖØ-öø-ɏ]+")
#: All letters of these words, and of the same in lower case; their only numbers are 0-9.
LETTERS = "A-Za-zÀ-ÖØ-öø-ʯⱥⱦ"
#: Weights of tokens, pieces and attention cost: tokens decide, the others break ties.
WEIGHTS = (1.0, 1e-3, 1e-3)


class Words:
    """The ids of words as little-endian unsigned 32-bit numbers, by a tokenizer of the ``tokenizers`` library.

    Words of ASCII and Latin letters are split by the tokenizer's own pattern, in lower case if it says so, and each part
    is looked up or given to its model; this is what the tokenizer does, without its bookkeeping of offsets. Other words,
    and all words of a tokenizer of another build, are encoded as a whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.known: dict[bytes, bytes] = {}
        self.former: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.letters = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(True))]
        parsed = json.loads(definition)
        self.added = [t["content"] for t in parsed["added_tokens"]]
        self.lower, pattern = _latin_rule(parsed)
        self.find = pattern.findall if pattern else None
        self.plain = LATIN.fullmatch
        self.special = re.compile("|".join(map(re.escape, self.added)) or "(?!)").search
        self.ids_of = self.tokenizer.model.tokenize

    def encode(self, text: bytes) -> bytes:
        found, at = [], 0
        while at < len(text):
            space = SPACE.search(text, at + PART)
            end = space.start() if space else len(text)
            found.append(self._part(text[at:end].split()))
            at = end
        return b"".join(found)

    def _part(self, words: list[bytes]) -> bytes:
        new = list(set(words).difference(self.known))
        if new:
            others, known, former, parts = [], self.known, self.former, self.parts.get
            for word in new:
                ids = former.get(word)
                if ids is None:
                    text = word.decode("utf-8", "replace")
                    if self.find is None or not self.plain(text) or self.special(text):
                        others.append((word, text))
                        continue
                    found = self.find(text.lower() if self.lower else text)
                    if len(found) == 1:
                        ids = parts(found[0]) or self._part_ids(found[0])
                    else:
                        ids = b"".join([parts(p) or self._part_ids(p) for p in found])
                known[word] = ids
            if others:
                encoded = self.tokenizer.encode_batch_fast([t for _, t in others], add_special_tokens=False)
                known.update((w, self._bytes(e.ids)) for (w, _), e in zip(others, encoded))
        joined = b"".join(map(self.known.__getitem__, words))
        if new and max(map(len, new)) > KNOWN_BYTES:
            for word in new:
                if len(word) > KNOWN_BYTES:
                    del self.known[word]
        if len(self.known) > KNOWN:  # words that occur again move on, the others go
            self.former, self.known = self.known, {}
        return joined

    def _bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.letters.__getitem__, ids))

    def _part_ids(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            tokens = self.ids_of(part if part.isascii() else _as_bytes(part))
            found = self.letters[tokens[0].id] if len(tokens) == 1 else self._bytes([t.id for t in tokens])
            if len(self.parts) >= KNOWN:
                self.parts.clear()
            if len(part) <= KNOWN_BYTES:
                self.parts[part] = found
        return found


def _byte_letters() -> dict[int, str]:
    """The letter of each byte in byte-level models: itself if it prints, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(0x100 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def _as_bytes(part: str) -> str:
    return part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)


def _latin_rule(definition: dict) -> tuple[bool, re.Pattern | regex.Pattern | None]:
    """Whether a tokenizer lower-cases, and its pattern of parts, if it treats LATIN by these two alone."""
    steps = definition["normalizer"]
    steps = steps["normalizers"] if steps and steps["type"] == "Sequence" else [steps]
    kinds = {s["type"] for s in steps if s}
    blanks = [s for s in steps if s and s["type"] == "Replace" and s["pattern"] != {"Regex": r"\s+"}]
    before = definition["pre_tokenizer"] or {}
    split = before.get("pretokenizers", [])
    plain = (kinds <= {"NFC", "Replace", "Lowercase"} and not blanks and [s["type"] for s in split] == ["Split", "ByteLevel"]
             and split[0]["behavior"] == "Removed" and split[0]["invert"] and "Regex" in split[0]["pattern"]
             and not split[1]["add_prefix_space"] and not split[1]["use_regex"])
    return "Lowercase" in kinds, _latin_pattern(split[0]["pattern"]["Regex"]) if plain else None


def _latin_pattern(pattern: str) -> re.Pattern | regex.Pattern:
    """The pattern for LATIN words, in lower case or not; by the faster library where classes of letters can be spelt out."""
    spelt = pattern.replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9")
    within = re.sub(r"\[[^\[\]]*\]", "", pattern)  # what is outside of brackets
    return regex.compile(pattern) if r"\p" in within or r"\p" in spelt.lower() else re.compile(spelt)


@functools.lru_cache(1)
def _words(definition: str) -> Words:
    return Words(definition)


def pieces(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", tokens: int = TOKENS,
           end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids): the pieces of each document; ids as little-endian unsigned 32-bit numbers.

    ``tokenizer`` is the path of a tokenizer file, read by the driver; its content, bounded by the vocabulary, is
    broadcast. ``start`` is the number of the document's ids before the piece.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    schema = StructType([StructField("doc_id", rows.schema["doc_id"].dataType), StructField("piece", IntegerType()),
                         StructField("start", LongType()), StructField("length", LongType()),
                         StructField("ids", BinaryType())])
    end, width = np.array([end_id], "<u4").tobytes(), 4 * tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(shared.value)

        def made(batch, row, place, ids):
            length = pa.array([len(i) // 4 for i in ids], pa.int64())
            start = pa.array([p * tokens for p in place], pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(place, pa.int32()), start, length,
                 pa.array(ids, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])

        for batch in batches:
            row, place, ids, size = [], [], [], 0
            for i, value in enumerate(batch.column(1)):
                whole = words.encode(value.as_py() or b"") + end
                for k, at in enumerate(range(0, len(whole), width)):
                    row.append(i)
                    place.append(k)
                    ids.append(whole[at:at + width])
                    size += width
                    if size > PART:
                        yield made(batch, row, place, ids)
                        row, place, ids, size = [], [], [], 0
            if row:
                yield made(batch, row, place, ids)

    return rows.mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """The bin of each item, by vector best-fit in order of falling weighted size; items of a size keep their order."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule}")
    if (sizes > capacity).any():
        raise ValueError("an item exceeds a capacity")
    scale = weights / capacity.astype(float) ** 2
    order = np.argsort(-(sizes / capacity) @ weights, kind="stable")
    least = sizes.min(axis=0) if len(sizes) else capacity
    found = np.empty(len(sizes), np.int64)
    free, number, bins = np.empty((0, len(capacity)), np.int64), np.empty(0, np.int64), 0
    opened: list[np.ndarray] = []  # bins begun since the arrays were built, at the end of them

    for nth, item in enumerate(order):
        size = sizes[item]
        if nth % 64 == 0 or opened:
            if opened:
                free = np.vstack([free, *[o[None] for o in opened]])
                number = np.r_[number, np.arange(bins - len(opened), bins)]
                opened = []
            if nth % 64 == 0:  # bins without room for the smallest item are closed
                open_ = (free >= least).all(axis=1)
                free, number = free[open_], number[open_]
        room = np.flatnonzero((free >= size).all(axis=1))
        if len(room):
            left = free[room] - size
            score = ((left * left) @ scale) if rule == "norm" else -((free[room] * size) @ scale)
            at = room[np.argmin(score)]
            free[at] -= size
            found[item] = number[at]
        else:
            found[item] = bins
            bins += 1
            opened.append(capacity - size)
    return found


def place(rows: DataFrame, tokens: int = TOKENS, most_pieces: int | None = None, most_attention: int | None = None,
          weights: tuple[float, float, float] = WEIGHTS, rule: str = "norm", group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``, the place in the sequence, to rows with a ``length``.

    Lengths are from 1 to ``tokens``. The other capacities are by default as large as ``tokens`` of them allow, so that
    they don't bind. All columns of ``rows`` are kept. Sequence ids are unique; they depend on how the rows are stored.
    """
    capacity = np.array([tokens, most_pieces or tokens, most_attention or tokens * tokens], np.int64)
    share = np.array(weights, float)
    names = rows.columns
    added = [StructField("sequence_id", LongType()), StructField("offset", LongType()), StructField("__full", LongType())]

    def packed(given: DataFrame, first: bool) -> DataFrame:
        groups = max(1, -(-given.count() // group))
        row = F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        dealt = given.withColumn("__group", F.pmod(row, F.lit(groups)).cast("long"))

        def pack(key: tuple, table: pa.Table) -> pa.Table:
            length = table.column("length").to_numpy()
            bins = best_fit(np.stack([length, np.ones_like(length), length * length], axis=1), capacity, share, rule)
            order = np.argsort(bins, kind="stable")
            before = np.cumsum(length[order]) - length[order]
            firsts = np.r_[True, bins[order][1:] != bins[order][:-1]]
            offset = np.empty(len(length), np.int64)
            offset[order] = before - np.maximum.accumulate(np.where(firsts, before, 0))
            full = np.bincount(bins, length).astype(np.int64)[bins]
            number = key[0].as_py() * (1 << 24) + bins
            number = number if first else -1 - number
            return table.drop_columns(["__group"]).append_column("sequence_id", pa.array(number)).append_column(
                "offset", pa.array(offset)).append_column("__full", pa.array(full))

        schema = StructType([*given.schema.fields, *added])
        return stage(dealt.groupBy("__group").applyInArrow(pack, schema), "packed")

    once = packed(stage(rows, "pieces"), True)
    open_ = F.col("__full") < int(FULL * tokens)
    again = packed(stage(once.where(open_).select(*names), "open-pieces"), False)
    return once.where(~open_).unionByName(again).drop("__full")


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", tokens: int = TOKENS,
         end_id: int = END_ID, **options) -> DataFrame:
    """``pieces`` of all documents with their places; ``options`` are those of ``place``."""
    return place(pieces(docs, tokenizer, doc_id, text, tokens, end_id), tokens, **options)

"""Language identification by cross-parsing entropy.

Per language, the suffix automaton of labelled text accepts exactly the substrings of that text. Parsing a new text with
it cuts the text into phrases, each the longest match that begins where the last one ended. A phrase costs about log2 of
the length of the labelled text in bits; the language with the fewest bits a letter wins. Text is reduced to classes
first: lower-cased letters, and one class for any run of other characters.

The automaton is completed to a table: a letter that ends a phrase leads to where the next phrase begins, and the entry
is marked. So parsing is one table look-up a letter, done for all texts of an Arrow batch side by side. A parse begins
anew after ``STRETCH`` classes, so that very long texts are parsed side by side as well; every letter is parsed.

Bounds: the labelled texts are a sample of ``SAMPLE_ROWS`` rows a language in hash order, and of each of them ``EXCERPT``
characters from a hashed place. Both hold for every language by itself, however many there are; a language takes about
two states a character. Prediction covers every text as a whole.

Defined results: ``und`` with score 0 for null, empty and letterless texts, and for all texts if nothing is labelled. Of
equally good languages the first in order wins. Letters that no labelled text has are phrases of their own. Repeated
rows get the same result. Other columns of the input are kept.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

SAMPLE_ROWS, EXCERPT = 100, 600
STRETCH = 1024
#: Letters with a class of their own; others share RARE classes by code point.
LETTERS, RARE = 60, 4
UNKNOWN = "und"
RESULT = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def sample(docs: DataFrame, learn: Column, lang: str = "lang", doc_id: str = "doc_id", text: str = "text",
           rows: int = SAMPLE_ROWS, excerpt: int = EXCERPT) -> dict[str, str]:
    """Labelled text of each language, from rows for which ``learn`` holds: ``rows`` of each, ``excerpt`` characters a row.

    The limit is on rows, so that a repeated id counts once a row. Each partition keeps its first rows of a language
    before they are shuffled.
    """
    size = F.length(text)
    start = F.pmod(F.xxhash64(doc_id, size), F.greatest(size - excerpt, F.lit(0)) + 1) + 1
    usable = docs.where(learn & F.col(lang).isNotNull() & (size > 0)).select(
        F.col(lang).alias("lang"), F.xxhash64(doc_id).alias("hash"), F.col(doc_id).alias("id"),
        F.substring(F.col(text), start.cast("int"), F.lit(excerpt)).alias("text"))
    chosen = usable.withColumn("nth", F.row_number().over(
        Window.partitionBy("lang").orderBy("hash", "id", "text"))).where(F.col("nth") <= rows)
    found: dict[str, list[tuple]] = {}
    for row in chosen.select("lang", "nth", "text").collect():
        found.setdefault(row["lang"], []).append((row["nth"], row["text"]))
    return {k: " ".join(t for _, t in sorted(found[k])) for k in sorted(found)}


@functools.lru_cache(1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def automaton(text: list[int], classes: int) -> np.ndarray:
    """Completed suffix automaton as a flat table: entry = 2 * classes * next state + (1 if a phrase ended)."""
    arrows, link, length, last = [{}], [-1], [0], 0
    for c in text:
        new = len(arrows)
        arrows.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in arrows[p]:
            arrows[p][c] = new
            p = link[p]
        if p >= 0:
            q = arrows[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                arrows.append(arrows[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and arrows[p].get(c) == q:
                    arrows[p][c] = len(arrows) - 1
                    p = link[p]
                link[q] = link[new] = len(arrows) - 1
        last = new
    first = np.full(classes, len(arrows), np.int32)  # the state after a letter that no phrase has
    for c, s in arrows[0].items():
        first[c] = s
    table = np.repeat((2 * classes * first + 1)[None, :], len(arrows) + 1, axis=0).astype(np.int32)
    table[0] -= 1  # the first letter ends no phrase
    rows = np.repeat(np.arange(len(arrows)), [len(a) for a in arrows])
    columns = np.fromiter((c for a in arrows for c in a), np.int64, len(rows))
    table[rows, columns] = 2 * classes * np.fromiter((s for a in arrows for s in a.values()), np.int64, len(rows))
    return table.ravel()


class CrossParser:
    """Parses texts with the automata of all languages."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.languages = [k for k, _ in texts]
        letters = Counter(c for _, t in texts for c in t.lower() if c.isalpha())
        known = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]
        self.classes = 1 + len(known) + RARE
        self.class_of = np.zeros(0x110000, np.int32)
        letter = np.flatnonzero(_is_letter())
        self.class_of[letter] = 1 + len(known) + letter % RARE
        for i, c in enumerate(known):
            for form in {c, c.upper()}:
                if len(form) == 1:
                    self.class_of[ord(form)] = 1 + i
        self.tables = [automaton(self.reduced(t).tolist(), self.classes) for _, t in texts]
        self.bits = np.array([np.log2(max(2, len(t))) for _, t in texts])

    def reduced(self, text: str) -> np.ndarray:
        """Classes of the characters; a run of characters that are no letters is one class 0."""
        c = self.class_of[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        return c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]] if len(c) else c

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        owner, pieces = [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), STRETCH):
                owner.append(i)
                pieces.append(t[at:at + STRETCH])
        result = np.zeros((len(texts), len(self.tables)), np.int64)
        if not pieces:
            return result
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((int(lengths.max()), len(pieces)), np.int32)
        for column, i in enumerate(order):
            grid[:lengths[i], column] = pieces[i]
        active = np.searchsorted(-lengths[order], -np.arange(len(grid)), side="left")
        owners = np.array(owner)[order]
        for k, table in enumerate(self.tables):
            state, count = np.zeros(len(pieces), np.int32), np.ones(len(pieces), np.int64)
            for step, n in enumerate(active):
                entry = table.take((state[:n] >> 1) + grid[step, :n])
                count[:n] += entry & 1
                state[:n] = entry
            np.add.at(result[:, k], owners, count)
        return result

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        reduced = [self.reduced(t) if t else np.zeros(0, np.int32) for t in texts]
        has_letter = np.array([bool((r != 0).any()) for r in reduced], bool)
        bits = self.phrases(reduced) * self.bits
        best = bits.argmin(axis=1)
        score = 1 / np.exp2(np.clip(bits.min(axis=1, keepdims=True) - bits, -60, 0)).sum(axis=1)
        names = np.array(self.languages, object)[best]
        return pd.DataFrame({"lang_pred": np.where(has_letter, names, UNKNOWN), "score": np.where(has_letter, score, 0.0)})


@functools.lru_cache(2)
def _parser(texts: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(texts)


def predict(docs: DataFrame, labelled: dict[str, str], text: str = "text") -> DataFrame:
    """Adds the struct ``language`` of ``lang_pred`` and ``score``; it is computed from ``text`` alone."""
    if not labelled:
        none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
        return docs.withColumn("language", none)
    texts = tuple(labelled.items())

    def run(batch: pd.Series) -> pd.DataFrame:
        return _parser(texts).predict(batch.tolist())

    run.__annotations__ = {"batch": pd.Series, "return": pd.DataFrame}
    return docs.withColumn("language", F.pandas_udf(run, RESULT)(F.col(text)))

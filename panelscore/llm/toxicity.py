"""Toxicity: Levenshtein automata over a learned lexicon, and context windows around the terms found.

The lexicon is a trie of words and word beginnings that are frequent in documents labelled toxic and rare in others. The
automaton of a word within one edit is intersected with the trie: a state is a set of (trie node, edits so far), and
transitions are made when first needed and kept, so that a word costs one look-up a letter. Beginnings match exactly, as
the path of a word in the trie passes them. A term has two weights, learned apart: one for exact matches, one for
misspelled ones.

In a text, matches are seen in windows of ``WINDOW`` words to either side. Others close by make abuse likelier; marks of
quotation make it less likely. Sums over the windows are the inputs of a logistic model.

Bounds: the lexicon and the model are fitted on at most ``SAMPLE_ROWS`` labelled documents in hash order and have at
most ``TERMS`` terms. Scores cover every text as a whole.

Defined results: null and empty texts score like texts without a match. Without labels of both kinds every score is the
share of toxic labels, or 0. A document with two different labels counts as toxic. Other columns of the input are kept.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from panelscore.llm.common import sampled_ids, words

SAMPLE_ROWS, TERMS = 20_000, 2_000
#: Documents that a term must occur in, and its least log-odds.
SUPPORT, LEAST = 3, 1.0
#: Lengths of word beginnings, and the least length of a term that is matched with an edit.
BEGINNINGS, FUZZY_LENGTH = (4, 5, 6, 7, 8, 9), 5
#: Share of a term's weight that a misspelling has which no labelled document shows.
UNSEEN = 0.75
WINDOW = 8
MARKS = "\"'`.,;:!?()[]{}<>|*#$%&«»„“”‚‘’…-—–/\\"
QUOTES = set("\"'`«»„“”‚‘’")
FEATURES = 7


def _log_odds(toxic: int, n: int, base: float) -> float:
    p = (toxic + 2 * base) / (n + 2)
    return math.log(p / (1 - p)) - math.log(base / (1 - base))


class Lexicon:
    """Trie of terms, intersected with Levenshtein automata. A term is a word or, ending in ``*``, a beginning."""

    def __init__(self, terms: dict[str, float], fuzzy: dict[str, float]):
        self.exact = {t: w for t, w in terms.items() if not t.endswith("*")}
        self.begins = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.fuzzy = fuzzy
        self.arrows: list[dict[str, int]] = [{}]
        self.term_at: dict[int, str] = {}
        for term in sorted(t for t in self.exact if len(t) >= FUZZY_LENGTH):
            node = 0
            for c in term:
                if c not in self.arrows[node]:
                    self.arrows.append({})
                    self.arrows[node][c] = len(self.arrows) - 1
                node = self.arrows[node][c]
            self.term_at[node] = term
        start = self._closed({(0, 0)})
        self.sets, self.steps = [start], [{}]
        self.number = {start: 0, frozenset(): -1}
        self.found: dict[str, tuple[float, str, bool] | None] = {}

    def _closed(self, states: set[tuple[int, int]]) -> frozenset:
        """Also skips one letter of a term; a node counts with its fewest edits."""
        least: dict[int, int] = {}
        for node, edits in states:
            least[node] = min(edits, least.get(node, 9))
        for node, edits in states:
            if edits == 0:
                for child in self.arrows[node].values():
                    least[child] = min(1, least.get(child, 9))
        return frozenset(least.items())

    def _step(self, state: int, c: str) -> int:
        after = set()
        for node, edits in self.sets[state]:
            if c in self.arrows[node]:
                after.add((self.arrows[node][c], edits))
            if edits == 0:
                after.add((node, 1))  # a letter too many
                after.update((child, 1) for child in self.arrows[node].values())  # another letter
        key = self._closed(after)
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
        self.steps[state][c] = self.number[key]
        return self.number[key]

    def near(self, word: str) -> str | None:
        """A term within one edit of the word; of several, the one with the largest weight."""
        state, steps = 0, self.steps
        for c in word:
            after = steps[state].get(c)
            state = self._step(state, c) if after is None else after
            if state < 0:
                return None
        hits = [self.term_at[node] for node, _ in self.sets[state] if node in self.term_at]
        return max(hits, key=lambda t: (self.exact[t], t)) if hits else None

    def match(self, token: str) -> tuple[float, str, bool] | None:
        """Weight, term and whether it is misspelled, for a lower-case token with its marks."""
        if token in self.found:
            return self.found[token]
        word, best = token.strip(MARKS), None
        if word in self.exact:
            best = (self.exact[word], word, False)
        for k in BEGINNINGS:
            if len(word) > k and (w := self.begins.get(word[:k])) is not None and (best is None or w > best[0]):
                best = (w, word[:k] + "*", False)
        if best is None and len(word) >= FUZZY_LENGTH - 1 and (term := self.near(word)):
            best = (self.fuzzy.get(term, UNSEEN * self.exact[term]), term, True)
        if len(self.found) > 300_000:  # bounded memory; matches are found again
            self.found.clear()
        self.found[token] = best
        return best

    def hits(self, text: str | None) -> tuple[list[str], dict[int, tuple[float, str, bool]]]:
        tokens = text.lower().split() if text else []
        toxic = {t: m for t in set(tokens) if (m := self.match(t)) is not None}
        return tokens, {i: toxic[t] for i, t in enumerate(tokens) if t in toxic} if toxic else {}

    def features(self, text: str | None) -> list[float]:
        """Largest weight, its share beside a quotation, weight of different terms, of misspelled ones alone, company."""
        tokens, hits = self.hits(text)
        if not hits:
            return [0.0] * FEATURES
        best = quoted = company = 0.0
        plain: dict[str, float] = {}
        bent: dict[str, float] = {}
        for i, (weight, term, misspelled) in hits.items():
            window = tokens[max(0, i - WINDOW):i + WINDOW + 1]
            marks = sum(c in QUOTES for t in window for c in (t[0], t[-1]))
            beside = sum(hits[j][0] for j in range(max(0, i - WINDOW), i + WINDOW + 1) if j in hits and j != i)
            if weight > best:
                best, quoted = weight, weight * (marks > 1)
            company = max(company, min(beside, 20.0))
            into = bent if misspelled else plain
            into[term] = max(into.get(term, 0.0), weight)
        return [1.0, best, quoted, min(sum(plain.values()) + sum(bent.values()), 40.0), min(sum(bent.values()), 40.0), company,
                math.log1p(len(hits)) - math.log1p(len(tokens))]


@functools.lru_cache(4)
def _lexicon(terms: tuple, fuzzy: tuple) -> Lexicon:
    return Lexicon(dict(terms), dict(fuzzy))


class Model:
    """Lexicon weights and the logistic model over the features of a text."""

    def __init__(self, terms: dict[str, float], fuzzy: dict[str, float], weights: list[float], share: float):
        self.terms, self.fuzzy = tuple(sorted(terms.items())), tuple(sorted(fuzzy.items()))
        self.weights, self.share = weights, share

    def lexicon(self) -> Lexicon:
        return _lexicon(self.terms, self.fuzzy)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.weights:
            return np.full(len(texts), self.share)
        lexicon = self.lexicon()
        x = np.array([lexicon.features(t) for t in texts]).reshape(len(texts), FEATURES)
        z = self.weights[0] + x @ np.array(self.weights[1:])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps for a ridge-regularised logistic model with an intercept."""
    a = np.c_[np.ones(len(x)), x]
    keep = np.diag([1e-3] + [ridge * 0.1] * x.shape[1])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + keep, a.T @ (y - p) - keep @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
        rows: int = SAMPLE_ROWS) -> Model:
    """``labels`` has (doc_id, toxic) of the documents to learn from."""
    known = labels.where(F.col("toxic").isNotNull() & F.col(doc_id).isNotNull())
    marked = known.groupBy(doc_id).agg(F.max("toxic").alias("toxic"))
    ids = marked.join(F.broadcast(sampled_ids(known, doc_id, rows)), doc_id, "left_semi").select(
        F.col(doc_id).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    sample = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(ids), "id")
    stripped = F.transform(words(F.lower("text")), lambda w: F.btrim(w, F.lit(MARKS)))
    whole = F.filter(F.array_distinct(stripped), lambda w: F.length(w) >= 3)
    begins = [F.transform(F.filter(whole, lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(
        F.substring(w, 1, k), F.lit("*"))) for k in BEGINNINGS]
    terms = F.explode(F.array_distinct(F.concat(whole, *begins))).alias("term")
    n, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == n:
        return Model({}, {}, [], float(bool(toxic)))
    base = toxic / n
    counted = (sample.select("toxic", terms).groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic"))
               .where((F.col("toxic") >= SUPPORT) & (F.col("toxic") > F.col("n") * base)))
    p = (F.col("toxic") + 2 * base) / (F.col("n") + 2)
    odds = F.log(p / (1 - p)) - math.log(base / (1 - base))
    best = counted.select("term", "n", "toxic", odds.alias("w")).where(F.col("w") >= LEAST + 1).orderBy(
        F.desc(F.col("w") * F.sqrt("toxic")), "term").limit(TERMS).collect()
    chosen = {r["term"]: r["w"] for r in best}
    # a beginning that says no more than the one before it adds nothing
    chosen = {t: w for t, w in chosen.items() if not (
        t.endswith("*") and (chosen.get(t[:-2] + "*") or -9.0) >= w)}
    lexicon = Model(chosen, {}, [], 0.0)
    fuzzy = _fuzzy_weights(sample, lexicon, base)
    model = Model(chosen, fuzzy, [], base)

    def run(batch: pd.Series) -> pd.Series:
        found = model.lexicon()
        return pd.Series([found.features(t) for t in batch])

    run.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    featured = sample.select("toxic", F.pandas_udf(run, ArrayType(DoubleType()))("text").alias("x")).collect()
    x, y = np.array([r["x"] for r in featured]), np.array([float(r["toxic"]) for r in featured])
    return Model(chosen, fuzzy, _logistic(x, y), base)


def _fuzzy_weights(sample: DataFrame, model: Model, base: float) -> dict[str, float]:
    """Log-odds of a toxic label where a term occurs misspelled; the weight without evidence counts as two documents."""
    def run(batch: pd.Series) -> pd.Series:
        lexicon = model.lexicon()
        return pd.Series([sorted({m[1] for m in lexicon.hits(t)[1].values() if m[2]}) for t in batch])

    run.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    bent = sample.select("toxic", F.explode(F.pandas_udf(run, ArrayType(StringType()))("text")).alias("term"))
    exact = dict(model.terms)
    found = {}
    for r in bent.groupBy("term").agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).collect():
        w = (_log_odds(r["toxic"], r["n"], base) * r["n"] + 2 * UNSEEN * exact[r["term"]]) / (r["n"] + 2)
        found[r["term"]] = max(0.0, w)
    return found


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score``, computed from ``text`` alone."""
    def run(batch: pd.Series) -> pd.Series:
        return pd.Series(model.scores(batch.tolist()))

    run.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    return docs.withColumn("score", F.pandas_udf(run, DoubleType())(F.col(text)))

"""Quality rules: Gopher-style counts of a text and the log-likelihood ratio of two hashed n-gram models.

The ratio compares two multinomials over hashed unigrams and bigrams: one of a trusted sample, one of all documents. A
document is scored by the mean log ratio of its features and rejected below a fixed threshold. All expressions are
built-in: one scan with a map-side combined count per bucket fits the model, one scan without a shuffle applies it.

Defined results: a null or blank text has no words and fails the base rules. A document without words has ratio 0.
Without trusted documents, or without any word, every ratio is 0, and only the base rules decide. Repeated rows are
scored alike and each counts. Other columns of the input, whatever their names, are neither read nor changed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.llm.common import SPACE, sampled_ids, words

BUCKETS = 8192
#: Bound of the labelled sample that the trusted model is fitted on.
TRUSTED_ROWS = 20_000
#: Mean log ratio below which a document is rejected.
THRESHOLD = -0.1
#: Fixed values of the base rules.
WINDOW = 8
MIN_WORDS = 20
SYMBOLS = "#*$%&|<>"


def _features(hashes: Column, buckets: int) -> Column:
    """Buckets of the words and of the pairs of neighbours; the last word pairs with the end."""
    pairs = F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))),
                       lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(buckets)).cast("int"))
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def _word_hashes(docs: DataFrame, text: str, *keep: Column) -> DataFrame:
    found = docs.select(*keep, F.col(text).alias("text"), words(F.col(text)).alias("words"))
    return found.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def fit(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
        trusted_rows: int = TRUSTED_ROWS) -> list[float]:
    """Log ratio of each bucket, trusted against all documents, both smoothed by one count a bucket.

    ``trusted`` has the ids of trusted documents; at most ``trusted_rows`` of them, by hash order, are used. The counts
    of the raw corpus cover every document. One number a bucket reaches the driver.
    """
    ids = sampled_ids(trusted, doc_id, trusted_rows).select(F.col(doc_id).alias("id"), F.lit(1).alias("trusted"))
    hashed = _word_hashes(docs, text, F.col(doc_id).alias("id"))
    flagged = hashed.join(F.broadcast(ids), "id", "left")
    counted = (flagged.select("trusted", F.explode(_features(F.col("hashes"), buckets)).alias("bucket"))
               .groupBy("bucket").agg(F.count("*").alias("n"), F.count("trusted").alias("t")).collect())
    raw, target = [1] * buckets, [1] * buckets
    for row in counted:
        raw[row["bucket"]] += row["n"]
        target[row["bucket"]] += row["t"]
    if sum(target) == buckets:
        return [0.0] * buckets
    shift = math.log(sum(raw)) - math.log(sum(target))
    return [math.log(t) - math.log(n) + shift for t, n in zip(target, raw)]


def _repeat_words(grams: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of all windows in order."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    pairs = F.zip_with(placed, F.slice(placed, 2, F.greatest(F.size(placed), F.lit(1))),
                       lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    return F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))


def _covered(starts: Column) -> Column:
    gaps = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
                      lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)


def measure(docs: DataFrame, ratios: list[float], doc_id: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """The counts and the verdict of every document, with the input row in ``row``."""
    log_ratio = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    n = F.size("hashes")
    hashed = _word_hashes(docs, text, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                          F.col(doc_id).alias("doc_id"))
    gram = hashed.withColumn("grams", F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    plain = F.col("text")
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    counted = gram.select(
        "row", "doc_id", n.cast("long").alias("n_words"),
        F.length(F.concat_ws("", "words")).cast("long").alias("word_chars"),
        F.coalesce(F.length("text") - F.length(plain), F.lit(0)).cast("long").alias("n_symbols"), lines.alias("lines"),
        F.when(F.size(F.array_distinct("grams")) < F.size("grams"), _repeat_words(F.col("grams"))).alias("starts"),
        (F.aggregate(_features(F.col("hashes"), len(ratios)), F.lit(0.0),
                     lambda s, b: s + F.get(log_ratio, b)) / F.greatest(2 * n, F.lit(1))).alias("ratio"))
    ruled = counted.select(
        "row", "doc_id", "n_words", "word_chars", "n_symbols",
        F.coalesce(F.size("lines") - F.size(F.array_distinct("lines")), F.lit(0)).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("long").alias("n_repeat_words"), "ratio")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return ruled.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def kept_documents(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, unchanged.

    A filter would be pushed below the projections and compute the counts again for each use of them; a generator
    is not, and computes them once.
    """
    measured = measure(docs, fit(docs, trusted, doc_id, text), doc_id, text)
    passed = F.filter(F.array(F.struct("row", "kept")), lambda x: x["kept"])
    return measured.select(F.explode(passed).alias("passed")).select("passed.row.*")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good."""
    return labels.where("quality = 1").select("doc_id")

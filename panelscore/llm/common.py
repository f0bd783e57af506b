"""Helpers the operators share: words, staged tables, bounded samples, connected components."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.session import configure, new_folder

#: Fixed values of the contracts: what counts as a word, and the white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
#: ``bytes.translate`` table that lower-cases A-Z and nothing else. ``bytes.split()`` cuts at exactly SPACE.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def session(spark: SparkSession) -> SparkSession:
    """Library settings, and Arrow batches small enough for tables of very long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    return spark


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: computed once, and safe when executors are lost.

    The folder is the session's ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a staged table that nothing will read again."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def split_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


def remainder(doc_id: Column, parts: int) -> Column:
    """The fold of a document, by the CRC-32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def sampled_ids(rows: DataFrame, doc_id: str, limit: int) -> DataFrame:
    """At most ``limit`` distinct ids, by the order of a hash; small enough to broadcast by the limit."""
    ids = rows.select(doc_id).where(F.col(doc_id).isNotNull()).distinct()
    return ids.orderBy(F.xxhash64(doc_id), doc_id).limit(limit)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of the undirected edges (a, b); a component is named by its smallest node.

    Alternates large-star and small-star steps until the edges no longer change. A step is a map-side combined minimum
    per node and a sort-merge join, whose hot nodes AQE splits. Every step is written to the shared folder.
    """
    def fingerprint(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    def linked(pairs: DataFrame) -> DataFrame:
        return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    current = stage(linked(edges.select("a", "b")), "edges")
    before = fingerprint(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = linked(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        stars = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
        current = stage(linked(stars), "edges")
        after = fingerprint(current)
        if after == before:
            break
        before = after
    stars = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.unionByName(roots)

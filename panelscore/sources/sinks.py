"""Month-partitioned Parquet tables.

Replacing months uses Spark's dynamic partition overwrite: tasks write to a staging folder and the
job commit moves the finished partitions, so a lost executor only repeats tasks and other months
are never touched.  The move itself is per month directory, not one transaction; ``write_months``
takes the name of a table format with transactions as ``fmt`` where its jar is present.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelscore.sources.tables import exists


def _schema_check(spark: SparkSession, df: DataFrame, path: str, allow_new: bool, fmt: str) -> None:
    if not exists(spark, path):
        return
    try:
        old = {f.name: f.dataType for f in spark.read.format(fmt).load(path).schema.fields}
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return  # a folder without files yet: another month is being written for the first time
    new = {f.name: f.dataType for f in df.schema.fields}
    wrong = [c for c in new if c in old and old[c] != new[c]]
    absent = [c for c in old if c not in new]
    added = [c for c in new if c not in old]
    if wrong or absent or (added and not allow_new):
        raise ValueError(f"schema differs from {path}: type {wrong}, absent {absent}, new {added}")


#: What a write can observe of its rows.
MEASURES = {"n_rows": lambda month: F.count(F.lit(1)), "first_month": lambda month: F.min(month),
            "last_month": lambda month: F.max(month), "n_null_month": lambda month: F.count_if(F.col(month).isNull())}


def balanced(df: DataFrame, month: str) -> DataFrame:
    """Rows gathered by month for writing.  AQE splits a month that is too large for one file and
    merges small ones, where a fixed number of partitions would do neither."""
    return df.hint("rebalance", F.col(month))


def write_months(df: DataFrame, path: str, month: str = "month", mode: str = "replace",
                 allow_new_columns: bool = True, balance: bool = True, fmt: str = "parquet",
                 observed: Observation | None = None) -> None:
    """Write by month.

    ``observed`` collects ``MEASURES`` of the rows while they are written. They are measured in the last stage, after the
    rows are dealt out, where a task that is run again counts once.

    mode "replace"  months present in ``df`` are replaced, all others stay
         "append"   rows are added
         "all"      the table is replaced as a whole, schema included
    """
    spark = df.sparkSession
    if mode != "all":
        _schema_check(spark, df, path, allow_new_columns, fmt)
    rows = balanced(df, month) if balance else df
    if observed is not None:
        rows = rows.observe(observed, *[build(month).alias(name) for name, build in MEASURES.items()])
    writer = rows.write.format(fmt).partitionBy(month)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == "all":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "static")
    elif mode == "append":
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode {mode}")
    writer.save(path)


def drop_month(spark: SparkSession, path: str, month: str, value: int) -> bool:
    """Remove one month directory."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{month}={int(value)}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.delete(folder, True))


def replace_month(df: DataFrame, path: str, value: int, month: str = "month",
                  allow_new_columns: bool = True) -> int:
    """Replace exactly one month and return the rows written.

    A row of another month fails the job before anything is committed.  An empty result removes
    the old month, which a partition overwrite alone would leave in place.  Rows are counted by the
    job that writes them; nothing is read again.
    """
    wrong = F.raise_error(F.concat(F.lit(f"row outside month {value}: "),
                                   F.coalesce(F.col(month).cast("string"), F.lit("null"))))
    guarded = df.withColumn(month, F.when(F.col(month) == F.lit(int(value)), F.col(month).cast("int"))
                            .otherwise(wrong.cast("int")))
    observed = Observation()
    write_months(guarded, path, month, "replace", allow_new_columns, observed=observed)
    rows = observed.get["n_rows"]
    if not rows:
        drop_month(df.sparkSession, path, month, value)
    return rows


def stage(df: DataFrame, path: str, month: str | None = None) -> DataFrame:
    """Write once, read back: the plan that follows starts at the files."""
    if month is None:
        df.write.mode("overwrite").parquet(path)
    else:
        write_months(df, path, month, "all")
    return df.sparkSession.read.parquet(path)


def written_months(spark: SparkSession, path: str, month: str = "month") -> DataFrame:
    """Rows per month as they are on disk."""
    return spark.read.parquet(path).groupBy(month).agg(F.count("*").alias("n_rows"))


def export_chunks(df: DataFrame, path: str, month: str = "month", rows_per_file: int = 100_000,
                  fmt: str = "parquet") -> None:
    """Per-month files of at most ``rows_per_file`` rows."""
    (balanced(df, month).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file)
     .partitionBy(month).format(fmt).save(path))


def write_metrics(frames: Mapping[str, DataFrame], path: str, fmt: str = "json") -> None:
    """A bundle of small metric tables, one folder each."""
    for name, df in frames.items():
        df.write.mode("overwrite").format(fmt).save(f"{path}/{name}")


def register(frames: Mapping[str, DataFrame]) -> None:
    """Temporary views by name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def unregister(spark: SparkSession, names) -> None:
    for name in names:
        spark.catalog.dropTempView(name)

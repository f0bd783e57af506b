"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_local_folder: str | None = None


def use_for_local_runs(folder: str) -> None:
    """Names the folder for staged tables of sessions that run in this process alone."""
    global _local_folder
    _local_folder = folder


def shared_dir(spark: SparkSession, default: str | None = None) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, else ``default``.

    A local folder is used only where it was named for local runs, and only by a session without executors
    of its own: on a cluster the executors would not share it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or default
    if not folder and re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        folder = _local_folder
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str, default: str | None = None) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark, default)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to a new path below the shared folder and reads it back: computed once, whatever reads it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, default: str | None = None) -> DataFrame:
    """Reliable checkpoint in the shared folder; the result survives the loss of executors."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(spark, default))
    return df.checkpoint()

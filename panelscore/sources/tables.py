"""Reading tables by name or path, and what can be asked about them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str, fmt: str | None = None, sep: str = ",",
               schema: T.StructType | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog name, or a path when it contains a slash.

    ``fmt``: parquet (default for paths), csv with header, delta or anything Spark can load.
    """
    if fmt is None and "/" not in name:
        df = spark.table(name)
    else:
        reader = spark.read.format(fmt or "parquet")
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.options(header="true", sep=sep)
        df = reader.load(name)
    return df.select(*columns) if columns else df


def read_folders(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Many month folders as one table, columns matched by name."""
    if fmt == "parquet":
        return spark.read.option("mergeSchema", "true").parquet(*paths)
    out = read_table(spark, paths[0], fmt)
    for p in paths[1:]:
        out = out.unionByName(read_table(spark, p, fmt), allowMissingColumns=True)
    return out


def month_slice(df: DataFrame, month: str, first: int, last: int | None = None) -> DataFrame:
    """One month or a range.  The predicate is on the raw partition column, so it prunes."""
    m = F.col(month)
    if last is None or last == first:
        return df.filter(m == F.lit(int(first)))
    return df.filter(m.between(int(first), int(last)))


def select_sql(spark: SparkSession, df: DataFrame, text: str, view: str = "source") -> DataFrame:
    """SQL text over one frame (``FROM {source}``), without leaving a view behind."""
    return spark.sql(text, **{view: df})


def exists(spark: SparkSession, name: str) -> bool:
    """Catalog table or non-empty folder."""
    if "/" not in name:
        return spark.catalog.tableExists(name)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(name)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(path) and len(fs.listStatus(path)) > 0


def probe(df: DataFrame, n: int = 10) -> dict[str, object]:
    """First rows, total count and column names."""
    return {"columns": df.columns, "count": df.count(), "rows": df.limit(n).collect()}


def describe(df: DataFrame) -> DataFrame:
    """(column, type, nullable) rows."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields],
        "column string, type string, nullable boolean")


def months_present(df: DataFrame, month: str) -> DataFrame:
    """Distinct months; reads the month column only."""
    return df.select(F.col(month).cast("int").alias("month")).distinct()


def inventory(tables: Mapping[str, DataFrame], months: Mapping[str, Column | str] | None = None) -> DataFrame:
    """One row per table: rows, columns, first and last month.  Only the month column is read."""
    rows = []
    for name, df in tables.items():
        m = (months or {}).get(name)
        c = F.lit(None).cast("int") if m is None else (F.col(m) if isinstance(m, str) else m).cast("int")
        rows.append(df.agg(F.count("*").alias("n_rows"), F.min(c).alias("first_month"),
                           F.max(c).alias("last_month"))
                    .select(F.lit(name).alias("table_name"), "n_rows",
                            F.lit(len(df.columns)).alias("n_columns"), "first_month", "last_month"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def verify_table(spark: SparkSession, name: str, required: Sequence[str], fmt: str | None = None) -> DataFrame:
    """The table, or an error that says whether it is absent, empty or lacks columns."""
    if not exists(spark, name):
        raise ValueError(f"table {name} does not exist")
    df = read_table(spark, name, fmt)
    absent = [c for c in required if c.lower() not in {x.lower() for x in df.columns}]
    if absent:
        raise ValueError(f"table {name} lacks {absent}")
    if df.isEmpty():
        raise ValueError(f"table {name} is empty")
    return df

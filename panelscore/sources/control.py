"""Control file (application, table, month field, lag), availability gate, missing months."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.functions.months import add_months, month_list

CONTROL_SCHEMA = "app string, table string, month_field string, lag int"


@dataclass(frozen=True)
class ControlRow:
    table: str
    month: str | Column
    lag: int


def read_control(spark: SparkSession, path: str) -> list[ControlRow]:
    """CSV with header; the lag is what must be added to the process month to get the source month."""
    rows = spark.read.schema(CONTROL_SCHEMA).option("header", "true").csv(path).collect()
    return [ControlRow(r["table"], r["month_field"], r["lag"]) for r in rows]


def availability(control: Sequence[ControlRow], tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
                 process_month: int) -> DataFrame:
    """(table_name, expected_month, last_month, n_rows, available) per control row.

    Reads nothing but the month columns.
    """
    out = None
    for row in control:
        df = tables(row.table) if callable(tables) else tables[row.table]
        m = (F.col(row.month) if isinstance(row.month, str) else row.month).cast("int")
        expected = add_months(process_month, row.lag)
        one = df.agg(F.max(m).alias("last_month"), F.count_if(m == expected).alias("n_rows")).select(
            F.lit(row.table).alias("table_name"), F.lit(expected).alias("expected_month"), "last_month",
            "n_rows", F.when(F.col("n_rows") > 0, 1).otherwise(0).alias("available"))
        out = one if out is None else out.unionByName(one)
    return out


def require_available(report: DataFrame) -> None:
    """Raise when a source has no data for its expected month."""
    absent = [f"{r['table_name']} {r['expected_month']}" for r in report.filter(F.col("available") == 0).collect()]
    if absent:
        raise ValueError(f"sources not available: {absent}")


def missing_months(present: DataFrame, required: Iterable[int], month: str = "month") -> DataFrame:
    """Required months without rows, as rows (month)."""
    wanted = present.sparkSession.createDataFrame([(int(m),) for m in required], f"{month} int")
    return wanted.join(present.select(F.col(month).cast("int").alias(month)).distinct(), month, "left_anti")


def rebuild_range(missing: DataFrame, month: str = "month") -> list[int]:
    """Smallest to largest missing month; months in between are rebuilt as well."""
    lo, hi = missing.agg(F.min(month), F.max(month)).first()
    return [] if lo is None else month_list(lo, hi)

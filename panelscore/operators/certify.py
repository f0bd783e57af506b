"""Certification of a produced table against a reference table.

Four checks, each with a value in percent and a light:

records          100 * smaller count / larger count            green from 99
schema           share of reference columns found with the same type   green at 100
data_match       mean match rate of the compared columns       green from 99, yellow from 96
critical_fields  share of critical columns that match in at least 99 % of the rows   green at 100

The table is certified when no check is red.  The global population governs the result; segments
are reported next to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.operators.compare import comparable, compare_rows, paired_by_segment, with_equality

GLOBAL = "global"


@dataclass(frozen=True)
class Thresholds:
    records_green: float = 99.0
    schema_green: float = 100.0
    match_green: float = 99.0
    match_yellow: float = 96.0
    critical_match: float = 99.0
    tolerance: float = 0.05


def schema_share(source: DataFrame, target: DataFrame, exclude: Sequence[str] = ()) -> float:
    have = {f.name: f.dataType for f in source.schema.fields}
    want = [f for f in target.schema.fields if f.name not in set(exclude)]
    found = sum(1 for f in want if have.get(f.name) == f.dataType)
    return 100.0 * found / len(want) if want else 100.0


def _traffic(value: Column, green: float, yellow: float | None = None) -> Column:
    expr = F.when(value >= green, F.lit("green"))
    if yellow is not None:
        expr = expr.when(value >= yellow, F.lit("yellow"))
    return expr.otherwise(F.lit("red"))


def _checks(rows: DataFrame, columns: Sequence[str], critical: Sequence[str], schema_pct: float,
            t: Thresholds, segment: Column, by: Sequence[str]) -> DataFrame:
    counts = rows.groupBy(*by).agg(
        F.sum("n_base").alias("__b"), F.sum("n_target").alias("__t"),
        *[(F.lit(100.0) * F.sum(f"{c}_eq") / F.count("*")).alias(f"__m_{c}") for c in columns])
    match = [F.col(f"__m_{c}") for c in columns]
    mean_match = sum(match[1:], match[0]) / F.lit(float(len(match)))
    hits = [F.when(F.col(f"__m_{c}") >= t.critical_match, 1.0).otherwise(0.0) for c in critical]
    critical_pct = (F.lit(100.0) * sum(hits[1:], hits[0]) / float(len(hits))) if hits else F.lit(100.0)
    small, large = F.least("__b", "__t"), F.greatest("__b", "__t")
    values = {
        "records": (F.lit(100.0) * small / large, t.records_green, None),
        "schema": (F.lit(float(schema_pct)), t.schema_green, None),
        "data_match": (mean_match, t.match_green, t.match_yellow),
        "critical_fields": (critical_pct, 100.0, None)}
    wide = counts.select(segment.alias("segment"), *[v.alias(k) for k, (v, _, _) in values.items()])
    each = F.explode(F.array(*[
        F.struct(F.lit(k).alias("check"), F.col(k).alias("value"),
                 _traffic(F.col(k), green, yellow).alias("light"))
        for k, (_, green, yellow) in values.items()]))
    return wide.select("segment", each.alias("c")).select("segment", "c.*")


def certify(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
            critical: Sequence[str] = (), exclude: Sequence[str] = (),
            thresholds: Thresholds = Thresholds()) -> DataFrame:
    """(segment, check, value, light) for the whole population."""
    ok, _ = comparable(source, target, [c for c in columns if c not in set(exclude)])
    rows = compare_rows(source, target, keys, ok, thresholds.tolerance)
    return _checks(rows, ok, [c for c in critical if c in ok], schema_share(source, target, exclude),
                   thresholds, F.lit(GLOBAL), [])


def certify_segments(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     segment: str, critical: Sequence[str] = (), exclude: Sequence[str] = (),
                     thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The global checks and those of every segment.

    A segment is compared within itself: a key that changed segment is one-sided in both.  All
    segments are evaluated by one grouped aggregate, however many there are; the pairs of the whole
    population come from those of the segments, so both tables are read once.
    """
    ok, _ = comparable(source, target, [c for c in columns if c not in {*exclude, segment}])
    share, kept = schema_share(source, target, exclude), [c for c in critical if c in ok]
    whole, within = (with_equality(p, ok, thresholds.tolerance)
                     for p in paired_by_segment(source, target, keys, segment, ok))
    return _checks(whole, ok, kept, share, thresholds, F.lit(GLOBAL), []).unionByName(
        _checks(within, ok, kept, share, thresholds, F.col(segment), [segment]))


def overall(report: DataFrame) -> DataFrame:
    """(segment, status, passed, failed, warnings)."""
    c = F.col("light")
    return report.groupBy("segment").agg(
        F.when(F.count_if(c == "red") == 0, F.lit("certified")).otherwise(F.lit("rejected")).alias("status"),
        F.count_if(c == "green").alias("passed"), F.count_if(c == "red").alias("failed"),
        F.count_if(c == "yellow").alias("warnings"))


def gate(report: DataFrame) -> None:
    """Raise unless the global population is certified."""
    red = [r["check"] for r in report.filter((F.col("segment") == GLOBAL) & (F.col("light") == "red")).collect()]
    if red:
        raise ValueError(f"certification failed: {sorted(red)}")

"""Data quality: key checks, variable profiles, monthly evolution, histograms, score buckets.

Definitions
-----------
profile     per variable: n (non-null), null_pct, zero_pct, n_distinct, mean, std (sample), min,
            p25, p50, p75, max.  Percentages are of all rows; NaN counts as null.
light       ``green`` / ``yellow`` / ``red`` by two thresholds on a metric.
evolution   the profile per variable and month; averages over the months weigh every month alike;
            a current value is judged by its relative deviation from the historical average.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.functions.scoring import PD_CUTS, bucket_labels, pd_bucket
from panelscore.operators import ranks

# Default thresholds (yellow from, red from) and histogram size.
NULL_PCT_LIGHT = (5.0, 20.0)
EVOLUTION_LIGHT = (0.05, 0.25)
HISTOGRAM_BINS = 30
COLUMNS_PER_PASS = 50


def light(metric, yellow: float, red: float) -> Column:
    """Green below ``yellow``, red from ``red`` upwards; an unknown metric is yellow."""
    m = F.col(metric) if isinstance(metric, str) else metric
    return (F.when(m.isNull(), F.lit("yellow")).when(m >= red, F.lit("red"))
            .when(m >= yellow, F.lit("yellow")).otherwise(F.lit("green")))


def key_check(df: DataFrame, key: str, exact: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """One row (per segment): null keys, keys, distinct keys, surplus rows.

    The exact form counts per key first (map-side combined); ``exact=False`` uses the sketch.
    """
    if not exact:
        return df.groupBy(*by).agg(F.count_if(F.col(key).isNull()).alias("null_keys"), F.count(key).alias("n_keys"),
                      F.approx_count_distinct(key).alias("n_distinct")).withColumn(
            "n_duplicates", F.greatest(F.col("n_keys") - F.col("n_distinct"), F.lit(0)))
    per_key = df.groupBy(*by, key).agg(F.count("*").alias("__n"))
    known = F.col(key).isNotNull()
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(~known, F.col("__n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(known, F.col("__n"))), F.lit(0)).alias("n_keys"),
        F.count(key).alias("n_distinct")).withColumn(
        "n_duplicates", F.col("n_keys") - F.col("n_distinct"))


_METRICS = ("n", "null_pct", "zero_pct", "mean", "std", "min", "max")


def _known(c: str) -> Column:
    """The value as double; NaN counts as null."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _moments(c: str) -> list[Column]:
    v = _known(c)
    rows = F.count("*")
    return [
        F.count(v).cast("double").alias(f"{c}|n"),
        (F.lit(100.0) * F.count_if(v.isNull()) / rows).alias(f"{c}|null_pct"),
        (F.lit(100.0) * F.count_if(v == 0) / rows).alias(f"{c}|zero_pct"),
        F.avg(v).alias(f"{c}|mean"), F.stddev_samp(v).alias(f"{c}|std"),
        F.min(v).alias(f"{c}|min"), F.max(v).alias(f"{c}|max")]


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, n, null_pct, zero_pct, mean, std, min, max) in one pass per 50 columns.

    The measures are computed side by side and turned into rows afterwards, when only one row per
    group is left.
    """
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        cols = list(columns[start:start + COLUMNS_PER_PASS])
        wide = df.groupBy(*by).agg(*[a for c in cols for a in _moments(c)])
        rows = F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), *[F.col(f"`{c}|{m}`").alias(m) for m in _METRICS])
            for c in cols]))
        parts.append(wide.select(*by, rows.alias("r")).select(*by, "r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("n", F.col("n").cast("bigint"))


def variable_profile(df: DataFrame, columns: Sequence[str], exact: bool = True,
                     null_light: tuple[float, float] = NULL_PCT_LIGHT,
                     by: Sequence[str] = ()) -> DataFrame:
    """One row per (segment and) variable with the profile metrics and the light of its null rate."""
    base = moments(df, columns, by)
    if exact:
        counts = ranks.value_counts(ranks.melt(df, columns, by), {"n": F.lit(1)}, by)
        extra = ranks.exact_quantiles(counts, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by=by)
    else:
        wide = df.groupBy(*by).agg(*[F.approx_count_distinct(_known(c)).alias(f"{c}|d") for c in columns],
                      *[F.percentile_approx(_known(c), [0.25, 0.5, 0.75]).alias(f"{c}|q")
                        for c in columns])
        rows = F.explode(F.array(*[F.struct(
            F.lit(c).alias("variable"), F.col(f"`{c}|d`").alias("n_distinct"),
            *[F.col(f"`{c}|q`")[i].alias(p) for i, p in enumerate(("p25", "p50", "p75"))])
            for c in columns]))
        extra = wide.select(*by, rows.alias("r")).select(*by, "r.*")
    return (_joined(base, extra, [*by, "variable"])
            .withColumn("n_distinct", F.coalesce(F.col("n_distinct"), F.lit(0)))
            .withColumn("null_light", light("null_pct", *null_light)))


def _joined(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join in which a missing segment is a segment of its own."""
    named = right.select(*[F.col(c).alias(f"__{c}") if c in on else F.col(c) for c in right.columns])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(named, same, "left").drop(*[f"__{c}" for c in on])


def light_counts(df: DataFrame, light_column: str) -> DataFrame:
    """KPI row: number of variables per light."""
    c = F.col(light_column)
    return df.agg(*[F.count_if(c == name).alias(name) for name in ("green", "yellow", "red")])


def evolution(history: DataFrame, columns: Sequence[str], month: str = "month") -> DataFrame:
    """Profile per (variable, month), long form."""
    return moments(history, columns, [month])


def evolution_pivot(evolution_rows: DataFrame, metric: str, months: Sequence[int],
                    month: str = "month") -> DataFrame:
    """One row per variable, one column ``m_YYYYMM`` per month of the list."""
    wide = evolution_rows.groupBy("variable").pivot(month, [int(m) for m in months]).agg(F.max(metric))
    return wide.select("variable", *[F.col(f"`{m}`").alias(f"m_{m}") for m in months])


def historical_averages(evolution_rows: DataFrame,
                        metrics: Sequence[str] = ("null_pct", "mean", "std")) -> DataFrame:
    return evolution_rows.groupBy("variable").agg(*[F.avg(m).alias(f"avg_{m}") for m in metrics])


def evolution_lights(current: DataFrame, averages: DataFrame, metric: str = "mean",
                     thresholds: tuple[float, float] = EVOLUTION_LIGHT) -> DataFrame:
    """Relative deviation of the current metric from its historical average, and its light."""
    avg = F.col(f"avg_{metric}")
    return (current.select("variable", F.col(metric).alias("current"))
            .join(averages.select("variable", avg.alias("average")), "variable", "left")
            .withColumn("deviation", F.try_divide(F.abs(F.col("current") - F.col("average")),
                                                  F.abs(F.col("average"))))
            .withColumn("light", light("deviation", *thresholds)))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = HISTOGRAM_BINS,
              by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, bin 1..bins, lower, upper, n) over equal-width bins; empty bins are left out.

    The largest value belongs to the last bin.  A constant variable has everything in bin 1.
    """
    ends = moments(df, columns, by).select(*by, "variable", "min", "max")
    long = ranks.melt(df, columns, by).filter(F.col("value").isNotNull())
    placed = _joined(long, ends, [*by, "variable"])
    width = (F.col("max") - F.col("min")) / F.lit(float(bins))
    raw = F.floor(F.try_divide(F.col("value") - F.col("min"), width)).cast("int") + 1
    number = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins))
    counts = (placed.withColumn("bin", number).groupBy(*by, "variable", "bin")
              .agg(F.count("*").alias("n"), F.first("min").alias("min"), F.first("max").alias("max")))
    return counts.select(*by, "variable", "bin",
                         (F.col("min") + (F.col("bin") - 1) * width).alias("lower"),
                         (F.col("min") + F.col("bin") * width).alias("upper"), "n")


def buckets_by_month(df: DataFrame, score: str, month: str = "month",
                     cuts: Sequence[float] = PD_CUTS, by: Sequence[str] = ()) -> DataFrame:
    """(by..., month, bucket, n, total, pct) with one row per month and report bucket, empty ones too.

    ``total`` also covers values below 0, which have no bucket of their own in the report.
    """
    labels = bucket_labels(cuts)
    per_month = df.withColumn("__bucket", pd_bucket(score, cuts)).groupBy(*by, month).agg(
        F.count("*").alias("total"), *[F.count_if(F.col("__bucket") == lab).alias(f"__b{i}") for i, lab in enumerate(labels)])
    rows = F.explode(F.array(*[F.struct(F.lit(lab).alias("bucket"), F.col(f"__b{i}").alias("n"))
                               for i, lab in enumerate(labels)]))
    return (per_month.select(*by, month, "total", rows.alias("r")).select(*by, month, "total", "r.*")
            .withColumn("pct", F.lit(100.0) * F.col("n") / F.col("total"))
            .select(*by, month, "bucket", "n", "total", "pct"))

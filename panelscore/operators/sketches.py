"""Monthly profile state: moments and sketches that can be merged, one partition a month.

A month is profiled once. What is kept of it per segment and variable is a row with counts, moments, an HLL sketch of the
distinct values and a KLL sketch of the distribution; profiles of any range of months are merged from these rows, and
history is never read again. Counts, means and deviations are exact, distinct values and quantiles have the error
of their sketches: about 1.6 % of the distinct values and 1.3 % of the ranks with the sizes below.

A rerun of a month replaces it with the same counts, moments and distinct values. KLL sketches draw random numbers while
they shrink: quantiles of a rerun may differ within their error. NaN counts as null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.operators import ranks
from panelscore.sources import sinks
from panelscore.sources.tables import month_slice

#: Logarithm of the buckets of an HLL sketch, and size of a KLL sketch.
HLL_BITS, KLL_SIZE = 12, 200


def month_state(rows: DataFrame, columns: Sequence[str], month: str = "month", by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, n_rows, n, n_zero, mean, m2, min, max, hll, kll, month): one aggregate, combined map-side.

    ``m2`` is the sum of squared deviations from the mean.
    """
    long = ranks.melt(rows, columns, [*by, month])
    v = F.col("value")
    return long.groupBy(*by, "variable", month).agg(
        F.count("*").alias("n_rows"), F.count(v).alias("n"), F.count_if(v == 0).alias("n_zero"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), HLL_BITS).alias("hll"),
        F.kll_sketch_agg_double(v, KLL_SIZE).alias("kll")).select(
        *by, "variable", "n_rows", "n", "n_zero", "mean", "m2", "min", "max", "hll", "kll", month)


def update_state(rows: DataFrame, path: str, columns: Sequence[str], months: Sequence[int], month: str = "month",
                 by: Sequence[str] = ()) -> None:
    """Profiles the given months of ``rows`` and replaces them in the state; other months are neither read nor written."""
    taken = month_slice(rows, month, min(months), max(months)).where(F.col(month).isin([int(m) for m in months]))
    sinks.write_months(month_state(taken, columns, month, by), path, month, "replace")


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_profile(state: DataFrame, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, n, null_pct, zero_pct, n_distinct, mean, std, min, max, quantiles) of all months of ``state``.

    Deviations are put together from those of the months and of their means, which loses no digits to large means.
    """
    n = F.col("n")
    known = F.when(n > 0, F.col("mean"))
    whole = state.groupBy(*by, "variable").agg(
        F.sum("n_rows").alias("__rows"), F.sum("n").alias("n"), F.sum("n_zero").alias("__zero"),
        F.try_divide(F.sum(known * n), F.sum("n")).alias("mean"), F.sum("m2").alias("__m2"), F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("n_distinct"),
        F.kll_merge_agg_double(F.when(n > 0, F.col("kll")), KLL_SIZE).alias("__kll"),
        F.collect_list(F.when(n > 0, F.struct("n", "mean"))).alias("__means"))  # a row a month
    between = F.aggregate("__means", F.lit(0.0), lambda s, m: s + m["n"] * (m["mean"] - F.col("mean")) * (m["mean"] - F.col("mean")))
    std = F.sqrt(F.try_divide(F.col("__m2") + between, F.col("n") - 1))

    def quantile(p: float) -> Column:
        return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("__kll", F.lit(float(p))))

    return whole.select(
        *by, "variable", "n", (F.lit(100.0) * (F.col("__rows") - F.col("n")) / F.col("__rows")).alias("null_pct"),
        (F.lit(100.0) * F.col("__zero") / F.col("__rows")).alias("zero_pct"), "n_distinct", "mean", std.alias("std"),
        "min", "max", *[quantile(p).alias(name) for name, p in probs.items()])


def evolution(state: DataFrame, by: Sequence[str] = (), month: str = "month") -> DataFrame:
    """(by..., variable, month, n, null_pct, mean, std) from the state: a projection, without an aggregate."""
    rows, n = F.col("n_rows"), F.col("n")
    return state.select(*by, "variable", month, "n", (F.lit(100.0) * (rows - n) / rows).alias("null_pct"), "mean",
                        F.sqrt(F.try_divide(F.col("m2"), n - 1)).alias("std"))


def rank_errors(rows: DataFrame, quantiles: DataFrame, probs: Mapping[str, float]) -> DataFrame:
    """(variable, one error per quantile): how far, as a share of the known values, a quantile's rank is from its place.

    ``quantiles`` has a row a variable. A quantile between equal values has any of their ranks.
    """
    found = F.broadcast(quantiles.select("variable", *[F.col(p).alias(f"__{p}") for p in probs]))  # a row a variable
    long = ranks.melt(rows, [r["variable"] for r in quantiles.select("variable").collect()]).where("value is not null")
    v, total = F.col("value"), F.count("*")

    def error(name: str, p: float) -> Column:
        below = F.count_if(v < F.col(f"__{name}")) / total
        upto = F.count_if(v <= F.col(f"__{name}")) / total
        return F.greatest(below - p, F.lit(p) - upto, F.lit(0.0)).alias(name)

    return long.join(found, "variable").groupBy("variable").agg(*[error(name, p) for name, p in probs.items()])

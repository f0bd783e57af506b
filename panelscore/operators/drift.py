"""Drift of the current month against the history, per variable.

PSI  sum over bins of (a - b) * ln(a / b); bins are the deciles of the base (history) plus one
     bin for nulls; shares are floored at 1e-6.  Bin i holds the values above i of the edges.
KS   largest distance between the two cumulative distributions; the p-value is the asymptotic
     series with the small-sample correction.

Both come from the same distinct-value counts, nulls among them, which are made in one pass over both sides and staged:
running counts, edges, bins and nulls read them. NaN counts as null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.operators import ranks
from panelscore.operators.profile import light
from panelscore.session import staged

# Customary limits and numeric floor.
PSI_LIGHT = (0.10, 0.25)
KS_SIGNIFICANT = 0.05
SHARE_FLOOR = 1e-6
KS_TERMS = 100


def side_counts(base: DataFrame, current: DataFrame, columns: Sequence[str],
                by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Counts per distinct value and per variable's nulls: ``b`` in the base, ``c`` in the current."""
    b = base.select(*by, *columns).withColumn("__side", F.lit(0))
    both = b.unionByName(current.select(*by, *columns).withColumn("__side", F.lit(1)))
    sides = {"b": F.lit(1) - F.col("__side"), "c": F.col("__side")}
    long = ranks.melt(both, columns, [*by, "__side"])
    every = staged(ranks.with_image(long.withColumns(sides).groupBy(*by, "variable", "value").agg(
        F.sum("b").alias("b"), F.sum("c").alias("c"))), "drift-counts")
    return every.where("value is not null"), every.where("value is null").drop("value", "image")


def _share(n: str, total: str) -> Column:
    return F.greatest(F.try_divide(F.col(n).cast("double"), F.col(total)), F.lit(SHARE_FLOOR))


def statistics(base: DataFrame, current: DataFrame, columns: Sequence[str], n_bins: int = 10,
               by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, psi, ks, ks_p) from the running counts of the distinct values."""
    group = [*by, "variable"]
    counts, nulls = side_counts(base, current, columns, by)
    rows = ranks.cumulative_counts(counts, ["b", "c"], by)
    gap = F.abs(F.try_divide(F.col("cum_b").cast("double"), F.col("total_b"))
                - F.try_divide(F.col("cum_c").cast("double"), F.col("total_c")))
    names = {f"e{i}": i / n_bins for i in range(1, n_bins)}
    aggs, edges = ranks.quantile_parts(names, "b")
    ends = rows.groupBy(*group).agg(*aggs, F.max(gap).alias("ks"), F.first("total_c").alias("total_c"))
    ends = ends.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("ks").alias("__ks"),
                       F.array_distinct(F.array(*edges.values())).alias("edges"))
    same = F.lit(True)
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    above = F.size(F.filter(F.col("edges"), lambda e: F.col("value") > e))
    bins = (rows.join(ends, same).withColumn("bin", above).groupBy(*group, "bin")
            .agg(F.sum("b").alias("b"), F.sum("c").alias("c"), F.first("__ks").alias("ks"),
                 F.first("total_b").alias("total_b"), F.first("total_c").alias("total_c")))
    bins = bins.unionByName(nulls.withColumn("bin", F.lit(-1)), allowMissingColumns=True)
    per_variable = Window.partitionBy(*group)  # at most n_bins + 1 rows
    shares = bins.withColumns({"__nb": F.sum("b").over(per_variable), "__nc": F.sum("c").over(per_variable)})
    pb, pc = _share("b", "__nb"), _share("c", "__nc")
    kept = [F.first(c, ignorenulls=True).alias(c) for c in ("ks", "total_b", "total_c")]
    out = shares.groupBy(*group).agg(F.sum((pc - pb) * F.log(pc / pb)).alias("psi"), *kept)
    n = F.try_divide(F.col("total_b").cast("double") * F.col("total_c"),
                     F.col("total_b").cast("double") + F.col("total_c"))
    lam = (F.sqrt(n) + 0.12 + F.try_divide(F.lit(0.11), F.sqrt(n))) * F.col("ks")
    return out.select(*group, "psi", "ks", ks_p_value(lam).alias("ks_p"))


def ks_p_value(lam: Column, terms: int = KS_TERMS) -> Column:
    """``2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)``, 1 where the series does not converge."""
    k = F.sequence(F.lit(1), F.lit(terms))
    total = F.aggregate(k, F.lit(0.0), lambda acc, i: acc + F.when(i % 2 == 1, 2.0).otherwise(-2.0)
                        * F.exp(F.lit(-2.0) * i * i * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).when(lam.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)))


def drift(base: DataFrame, current: DataFrame, columns: Sequence[str],
          psi_light: tuple[float, float] = PSI_LIGHT, by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, psi, psi_light, ks, ks_p, ks_light, summary); summary is the worse of the lights."""
    both = statistics(base, current, columns, by=by)
    both = both.withColumns({
        "psi_light": light("psi", *psi_light),
        "ks_light": F.when(F.col("ks_p") < KS_SIGNIFICANT, F.lit("red")).otherwise(F.lit("green"))})
    worse = (F.when((F.col("psi_light") == "red") | (F.col("ks_light") == "red"), F.lit("red"))
             .when(F.col("psi_light") == "yellow", F.lit("yellow")).otherwise(F.lit("green")))
    return both.select(*by, "variable", "psi", "psi_light", "ks", "ks_p", "ks_light", worse.alias("summary"))


def drift_kpis(results: DataFrame) -> DataFrame:
    """One row: variables per light, significant ones, mean and largest PSI."""
    c = F.col("psi_light")
    return results.agg(
        *[F.count_if(c == name).alias(name) for name in ("green", "yellow", "red")],
        F.count_if(F.col("ks_p") < KS_SIGNIFICANT).alias("n_significant"),
        F.avg("psi").alias("avg_psi"), F.max("psi").alias("max_psi"))

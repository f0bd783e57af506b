"""Calendar densification and month-to-month variation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.functions.features import decreasing_variation
from panelscore.operators.enrich import lag_snapshots


def month_grid(facts: DataFrame, party: str, months: Sequence[int], month: str = "month") -> DataFrame:
    """Every party of ``facts`` with every month of the list (an explode, not a cross join)."""
    calendar = F.array(*[F.lit(int(m)) for m in months])
    return facts.select(party).distinct().withColumn(month, F.explode(calendar))


def densify(facts: DataFrame, party: str, months: Sequence[int], amount: str,
            month: str = "month") -> DataFrame:
    """Sum per (party, month) on the full grid; months without rows hold null."""
    sums = (facts.filter(F.col(month).isin([int(m) for m in months]))
            .groupBy(party, month).agg(F.sum(amount).alias(amount)))
    return month_grid(sums, party, months, month).join(sums, on=[party, month], how="left")


def with_previous(grid: DataFrame, party: str, value: str, previous: str, month: str = "month") -> DataFrame:
    """Value of the row before.  On a dense grid that is the month before, and a party has exactly
    one row per calendar month, so no window partition grows with the data."""
    w = Window.partitionBy(party).orderBy(month)
    return grid.withColumn(previous, F.lag(value).over(w))


def mean_of_steps(months_oldest_first: Sequence[str]) -> Column:
    """Mean decreasing variation between consecutive value columns; unknown steps are left out."""
    names = list(months_oldest_first)
    steps = F.array(*[decreasing_variation(cur, prev) for prev, cur in zip(names, names[1:])])
    known = F.filter(steps, lambda x: x.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(known).cast("double"))


def mean_decrease(facts: DataFrame, party: str, months: Sequence[int], amount: str, out: str,
                  month: str = "month") -> DataFrame:
    """Mean decreasing variation over the listed months but the first, per party.

    Same result as densify -> previous month -> variation -> mean, in one aggregate: each month of
    the short list becomes a conditional sum, and the variation is arithmetic between them.
    Parties without rows in the listed months do not appear.
    """
    months = [int(m) for m in months]
    names = [f"__m{i}" for i in range(len(months))]
    sums = (facts.filter(F.col(month).isin(months)).groupBy(party)
            .agg(*[F.sum(F.when(F.col(month) == m, F.col(amount))).cast("double").alias(n)
                   for m, n in zip(months, names)]))
    return sums.select(party, mean_of_steps(names).alias(out))


def mean_decrease_before(base: DataFrame, facts: DataFrame, party: str, amount: str, out: str, steps: int = 3,
                         month: str = "month") -> DataFrame:
    """``mean_decrease`` of the ``steps`` months before each base row's month, for all months at once."""
    sums = facts.groupBy(month, party).agg(F.sum(amount).cast("double").alias(amount))
    lags = range(1, steps + 2)
    wide = lag_snapshots(base, sums, party, amount, lags, "__lag", month)
    names = [f"__lag_{k}" for k in reversed(lags)]
    return wide.withColumn(out, mean_of_steps(names)).drop(*names)

"""Aggregations from account level to customer level, and small report aggregates.

Everything is a hash aggregate with map-side partials: the shuffle carries at most one row per
key and map task, however many accounts a single customer has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rollup_accounts(accounts: DataFrame, keys: Sequence[str], valid: Column, *,
                    ids: Sequence[str] = (), valid_flag: str = "is_valid",
                    max_values: Mapping[str, str | Column] | None = None,
                    balances: Mapping[str, str | Column] | None = None,
                    flags: Mapping[str, Column] | None = None,
                    all_suffix: str | None = None) -> DataFrame:
    """Accounts -> one row per key, computed over the valid accounts.

    ids         largest id of the group
    valid_flag  1 if any account is valid
    max_values  largest value, 0 if there is none
    balances    sum of the positive balances, 0 if there is none
    flags       1 if any account fulfils the predicate
    all_suffix  also computes the measures over all accounts (balances of any sign), with this
                suffix on the name
    """
    zero, one = F.lit(0), F.lit(1)
    out = [F.max(c).alias(c) for c in ids]
    out.append(F.coalesce(F.max(F.when(valid, one)), zero).alias(valid_flag))
    for name, c in (max_values or {}).items():
        out.append(F.coalesce(F.max(F.when(valid, _c(c))), zero).alias(name))
    for name, c in (balances or {}).items():
        out.append(F.coalesce(F.sum(F.when(valid & (_c(c) > 0), _c(c))), zero).alias(name))
    for name, p in (flags or {}).items():
        out.append(F.coalesce(F.max(F.when(valid & p, one)), zero).alias(name))
    if all_suffix is not None:
        for name, c in (max_values or {}).items():
            out.append(F.coalesce(F.max(_c(c)), zero).alias(name + all_suffix))
        for name, c in (balances or {}).items():
            out.append(F.coalesce(F.sum(_c(c)), zero).alias(name + all_suffix))
        for name, p in (flags or {}).items():
            out.append(F.coalesce(F.max(F.when(p, one)), zero).alias(name + all_suffix))
    return accounts.groupBy(*keys).agg(*out)


def one_row_per_key(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """One deterministic row per key: the largest one in column order, nulls last.

    Replaces ``dropDuplicates``, whose survivor depends on the execution.  It is an aggregate, so
    a key with very many duplicates is reduced before the shuffle.
    """
    rest = [c for c in (columns or df.columns) if c not in set(keys)]
    if not rest:
        return df.select(*keys).distinct()
    if len(rest) == 1:
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]))
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{c}").alias(c) for c in rest])


def canonical_ids(rows: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """One id of each kind per key, the largest."""
    return rows.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ids])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def rows_per_month(df: DataFrame, month: str) -> DataFrame:
    return df.groupBy(month).agg(F.count("*").alias("n_rows"))


def describe_by_month(df: DataFrame, month: str, value: str) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value per month."""
    return df.groupBy(month).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))


def month_summary(df: DataFrame, month: str, customer: str, amount: str) -> DataFrame:
    """Customers and total amount in millions per month."""
    return df.groupBy(month).agg(F.count(customer).alias("n_customers"),
                                 (F.sum(amount).cast("double") / F.lit(1e6)).alias("amount_millions"))


def distinct_per_group(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """Rows and exact distinct values per group, in two steps: distinct (group, value) pairs are
    combined map-side first, so a frequent value costs one row."""
    pairs = df.groupBy(*group, column).agg(F.count("*").alias("__n"))
    return pairs.groupBy(*group).agg(F.sum("__n").alias("n_rows"),
                                     F.count(column).alias("n_distinct"))


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    spread_by: Sequence[str], salts: int = 64) -> DataFrame:
    """First ``n`` rows of each group.

    Ranked in two rounds: within (group, salt), then within the group over at most ``n * salts``
    rows, so a month that holds most of the table is not sorted in one task.
    """
    from pyspark.sql import Window

    from panelscore.operators.joins import spread

    salted = df.withColumn("__salt", spread(spread_by, salts))
    first = Window.partitionBy(*group, "__salt").orderBy(*order)
    second = Window.partitionBy(*group).orderBy(*order)
    local = salted.withColumn("__rank", F.row_number().over(first)).filter(F.col("__rank") <= n)
    return (local.withColumn("__rank", F.row_number().over(second))
            .filter(F.col("__rank") <= n).drop("__rank", "__salt"))

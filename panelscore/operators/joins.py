"""Equi-joins that stay balanced when one key is very frequent or missing.

No operator of the library forces a broadcast of a table.  Spark broadcasts a side when its own
size estimate, or the size AQE measures at run time, is below the session threshold; everything
else is a shuffled join.  ``broadcast`` is hinted only for relations whose row count is fixed by
the plan (a list of months, one row per variable or segment of it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def row_hash(columns: Sequence[str]) -> Column:
    """Stable hash of the row content (a task that is run again gets the same one)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns])


def spread(columns: Sequence[str], n: int) -> Column:
    """Stable number 0..n-1 from the row content."""
    return F.pmod(row_hash(columns), F.lit(n)).cast("int")


def left_lookup(base: DataFrame, source: DataFrame, on: Sequence[str], nullable: Sequence[str] = (),
                spread_by: Sequence[str] = ()) -> DataFrame:
    """Left join to a source that has one row per key.

    Rows whose key is null never match, but a plain shuffle still sends all of them to one task.
    With ``nullable`` those rows are shuffled by a hash of the columns ``spread_by`` as well. On both
    sides the extra key is computed from the key: a constant would be folded, and the shuffle would
    be by the key alone again.
    """
    if not nullable:
        return base.join(source, on=list(on), how="left")
    missing = F.lit(False)
    for c in nullable:
        missing = missing | F.col(c).isNull()
    same = F.pmod(F.xxhash64(*[F.col(c) for c in on]), F.lit(1))
    left = base.withColumn(_SALT, F.when(missing, row_hash(spread_by)).otherwise(same))
    right = source.withColumn(_SALT, same)
    return left.join(right, on=[*on, _SALT], how="left").drop(_SALT)


def lookup_join(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join row-level facts to a narrower table, reading the facts once.

    A frequent key is split at run time: AQE cuts its partition of the facts into parts of the
    advisory size and gives each the partition of ``dim``. There are as many parts as the key has
    rows for, and no list of frequent keys. Facts without key are spread in a left join and drop
    out of the others before the shuffle.
    """
    if how not in ("left", "inner", "left_semi"):
        raise ValueError("how must be 'left', 'inner' or 'left_semi'")
    if how == "left":
        return left_lookup(facts, dim, on, on, facts.columns)
    return facts.join(dim, on=list(on), how=how)


def full_merge(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Full outer merge of sources by key; one shuffle for all sources.

    A chain of full outer joins re-shuffles its growing result, because the key of an outer join
    is a coalesce. Stacking the sources and keeping one row per source and key needs one shuffle.
    Of several rows of a source with one key the largest is kept, as a whole. Rows with a null in
    their key match nothing and stay apart.
    """
    on = list(on)
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    values = {i: [c for c in f.columns if c not in on] for i, f in enumerate(frames)}
    keyed = [f.where(~missing).select(*on, F.struct(F.lit(1).alias("__in"), *values[i]).alias(f"__s{i}"))
             for i, f in enumerate(frames)]
    wide = keyed[0]
    for f in keyed[1:]:
        wide = wide.unionByName(f, allowMissingColumns=True)
    merged = wide.groupBy(*on).agg(*[F.max(f"__s{i}").alias(f"__s{i}") for i in values])
    merged = merged.select(*on, *[F.col(f"__s{i}.{c}").alias(c) for i in values for c in values[i]])
    for f in frames:
        if any(f.schema[c].nullable for c in on):
            merged = merged.unionByName(f.where(missing), allowMissingColumns=True)
    return merged


def with_side_flags(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "full",
                    flags: tuple[str, str] = ("in_left", "in_right")) -> DataFrame:
    """Full or inner join with 1/0 flags telling on which side the key exists.

    Rows without key match nothing. An inner join drops them before the shuffle; a full join spreads those of both
    sides by a hash of the row.
    """
    a, b = left.withColumn(flags[0], F.lit(1)), right.withColumn(flags[1], F.lit(1))
    keys = list(on)
    if how == "full":
        missing = F.lit(False)
        for c in keys:
            missing = missing | F.col(c).isNull()
        same = F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(1))
        a, b = (s.withColumn(_SALT, F.when(missing, row_hash(s.columns)).otherwise(same)) for s in (a, b))
        keys = [*keys, _SALT]
    return (a.join(b, on=keys, how=how).drop(_SALT)
            .withColumns({f: F.coalesce(F.col(f), F.lit(0)) for f in flags}))

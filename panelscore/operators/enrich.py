"""Attaching monthly feature sources to a customer-month panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.functions.months import add_months, month_index, shift_month
from panelscore.operators.joins import left_lookup, row_hash
from panelscore.operators.rollup import one_row_per_key
from panelscore.sources.tables import month_slice


@dataclass(frozen=True)
class FeatureSource:
    """A customer-month table: which columns to take, on which key, and its month lag.

    ``offset=+1`` means that a source row of month m serves base month m + 1.  ``unique`` says
    that the table already has one row per (month, key), which saves the de-duplication.
    ``serves=(first, last)`` is the range of base months; only partitions that serve it are read.
    """

    name: str
    frame: DataFrame
    columns: Mapping[str, str] | Sequence[str]
    key: str
    offset: int = 0
    month: str = "month"
    unique: bool = False
    nullable_key: bool = False
    serves: tuple[int, int] | None = None

    def prepared(self, month: str) -> DataFrame:
        cols = self.columns if isinstance(self.columns, Mapping) else {c: c for c in self.columns}
        rows = self.frame
        if self.serves is not None:
            rows = month_slice(rows, self.month, *[add_months(m, -self.offset) for m in self.serves])
        taken = rows.select(
            served_month(self.month, self.offset, self.key).alias(month), F.col(self.key),
            *[F.col(c).alias(new) for c, new in cols.items()])
        return taken if self.unique else one_row_per_key(taken, [month, self.key])


def served_month(month: str, offset: int, key: str) -> Column:
    """Month a source row serves; null for rows without key, which match nothing.

    The key is part of the expression on purpose.  A join key that depends on a partition column
    alone makes Spark insert a dynamic pruning filter that repeats the whole base plan, once per
    source and nested: the plan doubles with every join.  Ranges are pruned by ``serves`` instead.
    """
    return F.when(F.col(key).isNotNull(), shift_month(month, offset))


def enrich(base: DataFrame, sources: Sequence[FeatureSource], month: str = "month",
           spread_by: Sequence[str] | None = None) -> DataFrame:
    """Left-join every source straight to the base; the number of rows never changes.

    Sources are taken key by key, so the base is shuffled once per distinct key and not once per
    source: consecutive left joins on the same key keep its partitioning.  Rows without a nullable
    key are spread by ``spread_by`` (default: all base columns).
    """
    keys_in_order = list(dict.fromkeys(s.key for s in sources))
    by = list(spread_by) if spread_by is not None else list(base.columns)
    out, columns = base, list(base.columns)
    for key in keys_in_order:
        for s in (s for s in sources if s.key == key):
            nullable = [key] if s.nullable_key else []
            out = left_lookup(out, s.prepared(month), [month, key], nullable, by)
    for s in sources:
        columns += list(s.columns.values() if isinstance(s.columns, Mapping) else s.columns)
    return out.select(*columns)


def fixed_month(frame: DataFrame, read_month: int, stamp_month: int, key: str,
                columns: Mapping[str, str], month: str = "month", extra: Column | None = None,
                source_month: str = "month") -> DataFrame:
    """Rows of one month, renamed, distinct, stamped with the month being processed.

    The filter is on the raw month column, so partitions are pruned.
    """
    rows = frame.filter(F.col(source_month) == F.lit(int(read_month)))
    if extra is not None:
        rows = rows.filter(extra)
    return (rows.select(F.col(key), *[F.col(c).alias(new) for c, new in columns.items()]).distinct()
            .withColumn(month, F.lit(int(stamp_month)).cast("int")))


def fixed_months(frame: DataFrame, lag: int, key: str, columns: Mapping[str, str], month: str = "month",
                 extra: Column | None = None, source_month: str = "month") -> DataFrame:
    """``fixed_month`` for every month of the table in one pass; ``lag`` months later is stamped."""
    rows = frame if extra is None else frame.filter(extra)
    return rows.select(F.col(key), *[F.col(c).alias(new) for c, new in columns.items()],
                       shift_month(source_month, lag).alias(month)).distinct()


def lag_snapshots(base: DataFrame, source: DataFrame, key: str, value: str, lags: Sequence[int],
                  prefix: str, month: str = "month") -> DataFrame:
    """``prefix_k`` = value of the same customer k months earlier, for every k in ``lags``.

    Instead of one join per lag the two tables are stacked and read through range frames over the
    month index: one shuffle by customer, whatever the number of lags.  The source is reduced to
    one value per (month, customer) first, so a window partition holds at most two rows per month
    of a customer-month base.
    """
    values = (source.filter(F.col(key).isNotNull()).groupBy(month, key).agg(F.max(value).alias("__value"))
              .withColumns({"__is_base": F.lit(False), "__salt": F.lit(0)}))
    # rows without key match nothing; spread, so that they do not form one window partition
    alone = F.when(F.col(key).isNull(), row_hash(base.columns)).otherwise(F.lit(0))
    stacked = (base.withColumns({"__is_base": F.lit(True), "__salt": alone})
               .unionByName(values, allowMissingColumns=True).withColumn("__index", month_index(month)))
    w = Window.partitionBy(key, "__salt").orderBy("__index")
    names = {f"{prefix}_{k}": F.max("__value").over(w.rangeBetween(-k, -k)) for k in lags}
    return stacked.withColumns(names).filter("__is_base").select(*base.columns, *names)


def membership(base: DataFrame, members: DataFrame, on: Sequence[str], flag: str = "is_member") -> DataFrame:
    """Base with a 1/0 flag; ``members`` may hold duplicates. Rows without key are no members and are spread."""
    known = members.select(*on).distinct().withColumn(flag, F.lit(1))
    return left_lookup(base, known, on, on, base.columns).withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def only_members(value: str | Column, flag: str = "is_member") -> Column:
    """The value inside the segment, null outside."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(flag) == 1, v)


def attach_generated(master: DataFrame, scored: DataFrame, on: Sequence[str],
                     generated: Sequence[str]) -> DataFrame:
    """Only the generated columns of a scored table, joined back to the untouched master. Rows without key are spread."""
    return left_lookup(master, scored.select(*on, *generated), on, on, master.columns)

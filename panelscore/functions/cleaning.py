"""Null encodings: sentinel numbers, NaN and literal fills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers that stand for "no data" in the retail sources.
RETAIL_SENTINELS = (
    1111111111, -1111111111, 2222222222, -2222222222, 3333333333, -3333333333,
    4444444444, 44444444444, 5555555555, 6666666666, 7777777777, 99999,
)

# Numbers that stand for "no data" in the small-business sources.
BUSINESS_SENTINELS = (
    1111111111, -1111111111, 2222222222, -2222222222, 3333333333, -3333333333,
    4444444444, 5555555555, 6666666666, 7777777777, -99, -999,
    44444.4444, 555555.5555, 666666.6666, 77777.7777,
    111111.1111, -111111.1111, 222222.2222, -222222.2222, 333333.3333, -333333.3333,
)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _is_sentinel(c: Column, kind: T.DataType, sentinels: Sequence[float]) -> Column | None:
    if isinstance(kind, _WHOLE):
        whole = [int(s) for s in sentinels if float(s).is_integer()]
        return c.cast("bigint").isin(whole) if whole else None
    if isinstance(kind, T.FloatType):
        return c.isin([F.lit(float(s)).cast("float") for s in sentinels])
    return c.cast("double").isin([float(s) for s in sentinels])


def null_sentinels(df: DataFrame, sentinels: Sequence[float] | Mapping[str, Sequence[float]] = RETAIL_SENTINELS,
                   columns: Iterable[str] | None = None) -> DataFrame:
    """Sentinel -> null on numeric columns; every other column is left alone.

    One projection with one set lookup per column.  Text such as ``"99999"`` is kept: comparing a
    text column with numbers would be a failing cast under ANSI.  A mapping gives each column its own
    sentinels, and leaves columns that it does not name alone: an amount may well be 99999.
    """
    by_column = {c.lower(): s for c, s in sentinels.items()} if isinstance(sentinels, Mapping) else None
    wanted = by_column if columns is None else {c.lower() for c in columns}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        hit = None
        if isinstance(f.dataType, T.NumericType) and (wanted is None or f.name.lower() in wanted):
            own = sentinels if by_column is None else by_column.get(f.name.lower(), ())
            hit = _is_sentinel(c, f.dataType, own) if own else None
        out.append(c if hit is None else F.when(~hit, c).alias(f.name))
    return df.select(*out)


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """NaN -> null on float and double columns."""
    wanted = None if columns is None else set(columns)
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (wanted is None or f.name in wanted):
            c = F.nanvl(c, F.lit(None).cast(f.dataType)).alias(f.name)
        out.append(c)
    return df.select(*out)


def fill_nulls(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Null -> literal, per column; absent columns are ignored."""
    present = {c: v for c, v in values.items() if c in df.columns}
    return df.fillna(present) if present else df

"""Month keys: integers ``YYYYMM`` and arithmetic on them.

All month arithmetic of the library goes through this module.  On columns it is plain integer
arithmetic, so it stays inside whole-stage codegen and never parses dates per row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- on the driver ------------------------------------------------------------------------


def add_months(month: int, n: int) -> int:
    """``add_months(202512, 1) == 202601``."""
    index = (int(month) // 100) * 12 + int(month) % 100 - 1 + n
    return (index // 12) * 100 + index % 12 + 1


def month_list(first: int, last: int) -> list[int]:
    """All months from ``first`` to ``last``, both included, oldest first."""
    low, high = (m // 100 * 12 + m % 100 - 1 for m in (int(first), int(last)))
    return [i // 12 * 100 + i % 12 + 1 for i in range(low, high + 1)]


def months_back(month: int, n: int) -> list[int]:
    """``month`` and the ``n`` months before it, oldest first."""
    return month_list(add_months(month, -n), month)


def first_day(month: int) -> dt.date:
    return dt.date(int(month) // 100, int(month) % 100, 1)


# ---- on columns ---------------------------------------------------------------------------


def month_key(date) -> Column:
    """Date or timestamp -> int YYYYMM."""
    d = _col(date)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_index(month) -> Column:
    """Months since year 0, so that differences are month counts."""
    m = _col(month).cast("int")
    return (F.call_function("div", m, F.lit(100)) * 12 + m % 100 - 1).cast("int")


def from_index(index) -> Column:
    i = _col(index)
    return (F.call_function("div", i, F.lit(12)) * 100 + i % 12 + 1).cast("int")


def shift_month(month, n: int) -> Column:
    """Month moved by ``n``; null when the key is not a valid YYYYMM."""
    m = _col(month).cast("int")
    if n == 0:
        return m
    return F.when((m % 100).between(1, 12), from_index(month_index(m) + F.lit(n)))


def month_end(month) -> Column:
    """Last day of the month as a date."""
    m = _col(month).cast("int")
    return F.last_day(F.make_date(F.call_function("div", m, F.lit(100)).cast("int"), m % 100, F.lit(1)))


def parse_month(text) -> Column:
    """``'2025-03-01'``, ``'2025-03'`` or ``'202503'`` -> 202503; null when it is none of them."""
    t = F.trim(_col(text).cast("string"))
    digits = F.when(t.contains("-"), F.concat(F.substring(t, 1, 4), F.substring(t, 6, 2))).otherwise(t)
    m = digits.try_cast("int")
    return F.when((m % 100).between(1, 12), m)


def in_months(date, first: int, last: int) -> Column:
    """Predicate "date lies in first..last" written on the raw date, so that it reaches the scan."""
    d = _col(date)
    return (d >= F.lit(first_day(first))) & (d < F.lit(first_day(add_months(last, 1))))


def observed_months(df: DataFrame, column, to_month=None) -> list[int]:
    """Months between the smallest and the largest one present.  Two values reach the driver.

    ``to_month`` turns a raw column, such as a date, into its month: once for each end, not for every row.
    """
    ends = df.agg(F.min(_col(column)).alias("lo"), F.max(_col(column)).alias("hi"))
    lo, hi = (ends if to_month is None else ends.select(to_month("lo"), to_month("hi"))).first()
    return [] if lo is None else month_list(lo, hi)

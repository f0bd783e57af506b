"""Feature expressions of the scoring panels (column in, column out)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.functions.months import month_end, month_index


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Codes returned by a ratio that cannot be computed.
RATIO_BOTH_NULL = 44444444444
RATIO_NULL_OVER_ZERO = 6666666666
RATIO_NULL_OVER_POSITIVE = 1111111111
RATIO_NULL_OVER_NEGATIVE = -1111111111
RATIO_ZERO_OVER_NULL = 7777777777
RATIO_ZERO_OVER_ZERO = 5555555555
RATIO_POSITIVE_OVER_NULL = 2222222222
RATIO_NEGATIVE_OVER_NULL = -2222222222
RATIO_POSITIVE_OVER_ZERO = 3333333333
RATIO_NEGATIVE_OVER_ZERO = -3333333333


def _by_sign(x: Column, null: int, zero: int, positive: int, negative: int) -> Column:
    """The code for the sign of ``x``."""
    return F.when(x > 0, positive).when(x < 0, negative).when(x == 0, zero).otherwise(null).cast("bigint")


def ratio_with_sentinels(numerator, denominator) -> Column:
    """A / B rounded to 8 as decimal(19,8); impossible cases give the code of the case.

    The codes depend on what is missing: no numerator looks at the sign of B, no usable
    denominator looks at the sign of A.  A quotient beyond 11 integer digits gives null.
    """
    a, b = _col(numerator), _col(denominator)
    no_numerator = _by_sign(b, RATIO_BOTH_NULL, RATIO_NULL_OVER_ZERO, RATIO_NULL_OVER_POSITIVE,
                            RATIO_NULL_OVER_NEGATIVE)
    no_denominator = _by_sign(a, RATIO_BOTH_NULL, RATIO_ZERO_OVER_NULL, RATIO_POSITIVE_OVER_NULL,
                              RATIO_NEGATIVE_OVER_NULL)
    zero_denominator = _by_sign(a, RATIO_NULL_OVER_ZERO, RATIO_ZERO_OVER_ZERO, RATIO_POSITIVE_OVER_ZERO,
                                RATIO_NEGATIVE_OVER_ZERO)
    code = (F.when(a.isNull(), no_numerator)
            .when(b.isNull(), no_denominator)
            .when(b == 0, zero_denominator))
    quotient = F.round(F.try_divide(a.cast("double"), b.cast("double")), 8)
    return F.coalesce(code.cast("decimal(19,8)"), quotient.try_cast("decimal(19,8)"))


def plain_ratio(numerator, denominator) -> Column:
    """A / B; null on a zero or missing denominator."""
    return F.try_divide(_col(numerator), _col(denominator))


def clip(value, lower: float | None = None, upper: float | None = None) -> Column:
    """Value bounded to [lower, upper], nulls kept (``greatest``/``least`` alone would skip them)."""
    v = _col(value).cast("double")
    bounded = v
    if lower is not None:
        bounded = F.greatest(bounded, F.lit(float(lower)))
    if upper is not None:
        bounded = F.least(bounded, F.lit(float(upper)))
    return F.when(v.isNotNull(), bounded)


def apply_clips(df: DataFrame, rules: Iterable[tuple[str, str, float | None, float | None]]) -> DataFrame:
    """Rules (column, new column, lower, upper) in one projection; an absent column gives null."""
    known = {c.lower() for c in df.columns}
    new = {target: clip(source, lo, hi) if source.lower() in known else F.lit(None).cast("double")
           for source, target, lo, hi in rules}
    return df.withColumns(new) if new else df


def age_at_month_end(birth, month) -> Column:
    """Completed years on the last day of the month; null if unknown or born later."""
    b, ref = _col(birth).cast("date"), month_end(month)
    return F.when(b <= ref, F.floor(F.months_between(ref, b) / 12).cast("int"))


def age_by_months(birth, month, lower: float = 22.0, upper: float = 65.0) -> Column:
    """Age from month arithmetic: one decimal, bounded, then rounded to whole years."""
    b = _col(birth)
    years = F.round((month_index(month) - (F.year(b) * 12 + F.month(b) - 1)) / 12.0, 1)
    return F.round(clip(years, lower, upper), 0)


def max_of(*columns) -> Column:
    """Largest non-null value of the row."""
    cols = [_col(c) for c in columns]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def text_max(*columns) -> Column:
    """Largest number of the row; null, empty and non-numeric text is ignored."""
    return max_of(*[F.trim(_col(c).cast("string")).try_cast("double") for c in columns])


def any_flag(*columns, value: str = "1") -> Column:
    """``"1"`` if any of the flags is set, else ``"0"``; null flags count as unset."""
    hits = [F.coalesce(_col(c).cast("string") == F.lit(value), F.lit(False)) for c in columns]
    return F.when(reduce(lambda x, y: x | y, hits), F.lit("1")).otherwise(F.lit("0"))


def in_category(value, members: Sequence[str], null_is_member: bool = True) -> Column:
    """1 if the value is one of the members (or null), else 0."""
    v = _col(value)
    inside = F.coalesce(v.isin(list(members)), F.lit(null_is_member))
    return F.when(inside, F.lit(1)).otherwise(F.lit(0))


def flag_to_text(value) -> Column:
    """Numeric flag -> rounded whole number -> text."""
    return F.round(_col(value)).cast("int").cast("string")


def capped_log(value, lower: float | None = None, upper: float | None = None,
               log_lower: float | None = None, log_upper: float | None = None) -> Column:
    """``ln(1 + clip(x))``, optionally clipped again on the log scale; nulls kept."""
    return clip(F.log1p(clip(value, lower, upper)), log_lower, log_upper)


def impute(value, default: float = 0.0, floor: float | None = None) -> Column:
    """Null -> default; with ``floor``, smaller values are raised to it."""
    filled = F.coalesce(_col(value).cast("double"), F.lit(float(default)))
    return filled if floor is None else F.greatest(filled, F.lit(float(floor)))


def step_round(value, step: int = 2) -> Column:
    """Rounded up to a multiple of ``step``; null and values below 1 give 0."""
    v = _col(value)
    kept = F.when(v >= 1, v).otherwise(F.lit(0))
    return (F.ceil(kept / float(step)) * step).cast("int")


def decreasing_variation(current, previous) -> Column:
    """Size of a decrease, 0 for an increase, null if neither month has a value."""
    cur, prev = _col(current), _col(previous)
    drop = F.coalesce(prev, F.lit(0)) - F.coalesce(cur, F.lit(0))
    return F.when(cur.isNotNull() | prev.isNotNull(), F.greatest(drop, F.lit(0)))


def override(material, base) -> Column:
    """The material value where there is one, the base value elsewhere."""
    return F.coalesce(_col(material), _col(base))


def own_or_owner_max(entity_type, own, owner, company: str = "6") -> Column:
    """Persons keep their own value; companies (and unknown types) take the larger of the two."""
    return F.when(_col(entity_type) != F.lit(company), _col(own)).otherwise(max_of(own, owner))


def convert_currency(currency, amount, rate, local: str = "0001", foreign: str = "1001") -> Column:
    """Foreign amounts times rate, local amounts as they are, any other currency null."""
    cur = _col(currency)
    return (F.when(cur == F.lit(foreign), _col(amount) * _col(rate))
            .when(cur == F.lit(local), _col(amount)))


def same_within(left, right, tolerance: float = 1e-6) -> Column:
    """1 when both are null or differ by at most the tolerance, else 0 (also one-sided null)."""
    a, b = _col(left), _col(right)
    close = F.coalesce(F.abs(a - b) <= F.lit(tolerance), F.lit(False))
    return F.when((a.isNull() & b.isNull()) | close, F.lit(1)).otherwise(F.lit(0))


def same_text(left, right) -> Column:
    """1 when equal or both null, else 0."""
    return F.when(_col(left).eqNullSafe(_col(right)), F.lit(1)).otherwise(F.lit(0))


def changed(before, after) -> Column:
    """Predicate: both values are known and differ."""
    a, b = _col(before), _col(after)
    return a.isNotNull() & b.isNotNull() & (a != b)


def trimmed_in(column, values: Sequence[str]) -> Column:
    """Predicate: the value without padding is one of ``values``."""
    return F.trim(_col(column)).isin(list(values))


def any_pair(first, second, pairs: dict[str, Sequence[str]]) -> Column:
    """Predicate: (first, second) is one of the allowed combinations, padding ignored."""
    a, b = F.trim(_col(first)), F.trim(_col(second))
    return reduce(lambda x, y: x | y, [(a == F.lit(k)) & b.isin(list(v)) for k, v in pairs.items()])

"""Exact order statistics of many columns by radix refinement, without a global sort in one task.

A cumulative count over all values of a variable would put the variable into one window partition. Here distinct values
are counted with map-side combine, and a range of values is split again while it holds too many of them:

* A double has an image, a signed 64-bit number in the same order: its bit pattern.
* The first ranges are those of sign, exponent and six more bits. A histogram over the ranges tells how many values each one holds. Ranges
  above ``MOST_VALUES`` are split by the next ``DIGIT`` bits, with a histogram over their parts alone, until none is left
  that is too large; in the sixth round a range is a single value.
* The ranges form a tree. A part's offset is that of the range it is from and the parts before it, so a window over
  ranges has 2**DIGIT rows at most (2**18 in the first round), and one over values ``MOST_VALUES``, whatever the
  distribution: timestamps of one month, large ids and scores near 1 are cut as finely as they need.

Nothing is sampled; of the data the driver learns only whether a range is left to split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.session import staged

#: Distinct values of a range that is not split again, and the bits of a split.
MOST_VALUES = 100_000
DIGIT = 10
#: Bits of a double below its exponent, and those below the first ranges: 64 ranges an octave.
_FRACTION, FIRST_SHIFT = 52, 46


def melt(df: DataFrame, columns: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Wide -> (ids..., variable, value) with values as double; NaN counts as null."""
    wide = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot(list(ids), list(columns), "variable", "value")
    return long.withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def with_image(df: DataFrame, value: str = "value", name: str = "image") -> DataFrame:
    """Adds a signed 64-bit number in the order of the doubles ``value``: the bits of the absolute value, with its sign.

    Zeros have 0 and infinities the numbers beyond all others; null and NaN have null.
    """
    size, least = F.abs(value), 2.0 ** -1022
    plain = F.when((size >= least) & (size < float("inf")), size).otherwise(1.0)
    made = df.withColumn("__size", plain).withColumn(
        "__e", F.greatest(F.least(F.floor(F.log2("__size")), F.lit(1023)), F.lit(-1022)))
    made = made.withColumn("__part", F.col("__size") / F.pow(F.lit(2.0), F.col("__e")))
    # the logarithm may be off by one beside a power of two
    over, under = F.col("__part") >= 2, F.col("__part") < 1
    part = F.col("__part") * F.when(over, 0.5).when(under, 2.0).otherwise(1.0) - 1
    exponent = F.col("__e") + F.when(over, 1).when(under, -1).otherwise(0) + 1023
    normal = exponent * (1 << _FRACTION) + (part * float(1 << _FRACTION)).cast("long")
    tiny = (F.when(size < least, size).otherwise(0.0) / 5e-324).cast("long")
    bits = F.when(size == float("inf"), F.lit(2047 << _FRACTION)).when(size < least, tiny).otherwise(normal)
    signed = F.when(F.col(value) < 0, -bits).when(F.col(value).isNotNull() & ~F.isnan(value), bits)
    return made.withColumn(name, signed).drop("__size", "__e", "__part")


def _start(shift: int) -> Column:
    """The least image of the range that a value is in."""
    return F.shiftleft(F.shiftright("image", shift), shift)


def value_counts(long: DataFrame, weights: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, value, one count per weight) for every distinct non-null value.

    ``weights`` names the populations, for example ``{"n": lit(1)}`` or one 0/1 column per side. ``by`` has the
    segments, for which everything below is computed apart.
    """
    return (long.filter(F.col("value").isNotNull()).withColumns(dict(weights))
            .groupBy(*by, "variable", "value").agg(*[F.sum(n).alias(n) for n in weights]))


def _same(group: Sequence[str], prefix: str) -> Column:
    """Equality with columns of a prefix, in which a missing segment is a segment of its own."""
    found = F.lit(True)
    for g in group:
        found = found & F.col(g).eqNullSafe(F.col(f"{prefix}{g}"))
    return found


def _named(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in columns],
                     *[F.col(c) for c in df.columns if c not in columns])


def value_ranges(counts: DataFrame, names: Sequence[str], by: Sequence[str] = (),
                 most: int = MOST_VALUES) -> list[tuple[int, DataFrame]]:
    """Per round of the refinement its shift and the ranges that are not split again.

    A range is (by..., variable, start) with ``n_values``, per weight the count ``o_`` of all values before it, and the
    ``total_`` of the variable. ``counts`` has an ``image`` and is read once a round.
    """
    names, group = list(names), [*by, "variable"]
    shift, former, found, heavy = FIRST_SHIFT, FIRST_SHIFT, [], None
    while True:
        rows = counts.withColumn("start", _start(shift))
        if heavy is None:
            sums = rows.groupBy(*group, "start")
        else:
            inside = _named(heavy.select(*group, "start", *[f"o_{n}" for n in names], *[f"total_{n}" for n in names]),
                            [*group, "start"], "__p_")
            kept = [f"o_{n}" for n in names] + [f"total_{n}" for n in names]
            rows = rows.withColumn("__former", _start(former)).join(
                inside, _same(group, "__p_") & (F.col("__former") == F.col("__p_start")))
            sums = rows.groupBy(*group, "__former", *kept, "start")
        sums = sums.agg(F.count("*").alias("n_values"), *[F.sum(n).alias(n) for n in names])
        whole = Window.partitionBy(*group, *([] if heavy is None else ["__former"]))
        before = whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
        begin = {n: F.lit(0) if heavy is None else F.col(f"o_{n}") for n in names}
        placed = sums.withColumns({f"__o_{n}": begin[n] + F.coalesce(F.sum(n).over(before), F.lit(0)) for n in names})
        if heavy is None:
            placed = placed.withColumns({f"total_{n}": F.sum(n).over(whole) for n in names})
        ranges = staged(placed.select(*group, "start", "n_values", *[F.col(f"__o_{n}").alias(f"o_{n}") for n in names],
                                      *[f"total_{n}" for n in names]), "ranges")
        large = (F.col("n_values") > most) if shift else F.lit(False)
        found.append((shift, ranges.where(~large)))
        heavy = ranges.where(large)
        if not shift or heavy.isEmpty():
            return found
        shift, former = max(0, shift - DIGIT), shift


def cumulative_counts(counts: DataFrame, names: Sequence[str], by: Sequence[str] = (),
                      most: int = MOST_VALUES) -> DataFrame:
    """``value_counts`` plus a ``cum_`` count and a ``total_`` per weight, in the order of the values.

    Counts with an ``image`` are staged already; others are staged here, since they are read several times.
    """
    names, group = list(names), [*by, "variable"]
    imaged = counts if "image" in counts.columns else staged(with_image(counts), "value-counts")
    parts = []
    for shift, ranges in value_ranges(imaged, names, by, most):
        inside = Window.partitionBy(*group, "start").orderBy("value").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        rows = imaged.withColumn("start", _start(shift)).join(
            _named(ranges, [*group, "start"], "__r_"), _same([*group, "start"], "__r_"))
        parts.append(rows.select(
            *group, "value", *names, *[(F.sum(n).over(inside) + F.col(f"o_{n}")).alias(f"cum_{n}") for n in names],
            *[f"total_{n}" for n in names]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def quantile_parts(probs: Mapping[str, float], weight: str = "n") -> tuple[list[Column], dict[str, Column]]:
    """Aggregates over ``cumulative_counts`` of one variable, and the quantiles built from them.

    Same definition as ``percentile`` (interpolated).  Each quantile is two conditional minima over
    the cumulative counts, so it combines map-side.
    """
    total = f"total_{weight}"
    aggs, out = [F.first(total).alias(total)], {}
    for name, p in probs.items():
        position = (F.col(total) - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            aggs.append(F.min(F.when(F.col(f"cum_{weight}") > rank, F.col("value"))).alias(f"__{name}_{side}"))
        lo, hi = F.col(f"__{name}_lo"), F.col(f"__{name}_hi")
        out[name] = lo + (hi - lo) * (position - F.floor(position))
    return aggs, out


def exact_quantiles(counts: DataFrame, probs: Mapping[str, float], weight: str = "n",
                    by: Sequence[str] = ()) -> DataFrame:
    """One row per segment and variable: the quantiles and ``n_distinct``."""
    rows = cumulative_counts(counts, [weight], by)
    aggs, out = quantile_parts(probs, weight)
    return (rows.groupBy(*by, "variable").agg(*aggs, F.count("*").alias("n_distinct"))
            .select(*by, "variable", "n_distinct", *[c.alias(n) for n, c in out.items()]))

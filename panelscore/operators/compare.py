"""Tolerance-based comparison of two tables, schemas, null rates and scores.

Tables are compared by stacking both sides and grouping by key, not by an outer join: one shuffle,
map-side combined, and a key that occurs many times on both sides costs one row instead of all
pairs.  Keys are expected to be unique; repeated keys are counted and never count as equal.

Large tables that differ in few places are narrowed first: digests by month and block of keys tell which blocks differ,
and only the rows of these are shuffled and compared (``differing_parts``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelscore.functions.features import same_text, same_within
from panelscore.session import staged

TOLERANCE = 1e-6
PASS_PCT = 99.0


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.NumericType):
        return "number"
    return "text" if isinstance(t, T.StringType) else "other"


def comparable(base: DataFrame, target: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """Columns that can be compared (number with number, text with text) and the skipped ones with
    the reason."""
    ok, skipped = [], []
    for c in columns:
        if c not in base.columns or c not in target.columns:
            skipped.append((c, "missing"))
            continue
        a, b = _kind(base.schema[c].dataType), _kind(target.schema[c].dataType)
        (ok.append(c) if a == b != "other" else skipped.append((c, f"{a} vs {b}")))
    return ok, skipped


def common_columns(base: DataFrame, target: DataFrame, keys: Sequence[str], exclude: Sequence[str] = ()) -> list[str]:
    skip = set(keys) | set(exclude)
    return [c for c in base.columns if c in target.columns and c not in skip]


def _stacked(base: DataFrame, target: DataFrame, keep: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Both sides with ``__side`` 0 and 1; numbers as double."""
    def side(df: DataFrame, mark: int) -> DataFrame:
        return df.select(*keep, *[F.col(c).cast("double").alias(c)
                                  if _kind(df.schema[c].dataType) == "number" else F.col(c)
                                  for c in columns], F.lit(mark).alias("__side"))

    return side(base, 0).unionByName(side(target, 1))


def _missing(keys: Sequence[str]) -> Column:
    found = F.lit(False)
    for k in keys:
        found = found | F.col(k).isNull()
    return found


def _values(columns: Sequence[str]) -> list[Column]:
    here = {"base": F.col("__side") == 0, "target": F.col("__side") == 1}
    return [*[F.count_if(p).alias(f"n_{s}") for s, p in here.items()],
            *[F.max(F.when(p, F.col(c))).alias(f"{c}_{s}") for c in columns for s, p in here.items()]]


def paired(base: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: ``n_base``, ``n_target`` and ``<c>_base`` / ``<c>_target`` values.

    Rows with a null in their key match nothing and stay rows of their side; equal ones count as repeated.
    """
    both = _stacked(base, target, keys, columns)
    missing = _missing(keys)
    both = both.withColumn("__alone", F.when(missing, F.xxhash64("__side", *columns)).otherwise(F.lit(0)))
    both = both.withColumn("__lone_side", F.when(missing, F.col("__side")))
    return both.groupBy(*keys, "__alone", "__lone_side").agg(*_values(columns)).drop("__alone", "__lone_side")


def paired_by_segment(base: DataFrame, target: DataFrame, keys: Sequence[str], segment: str,
                      columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``paired`` by the keys and by keys and segment, from one aggregate over both tables.

    The pairs of the keys are a second aggregate over those of keys and segment, which Spark computes once for both.
    """
    both = _stacked(base, target, [*keys, segment], columns)
    alone = _missing([*keys, segment])
    both = both.withColumn("__alone", F.when(alone, F.xxhash64("__side", *columns)).otherwise(F.lit(0)))
    both = both.withColumn("__lone_side", F.when(alone, F.col("__side")))
    within = both.groupBy(*keys, segment, "__alone", "__lone_side").agg(*_values(columns))
    missing = _missing(keys)
    whole = within.withColumn("__alone", F.when(missing, F.col("__alone")).otherwise(F.lit(0))).withColumn(
        "__lone_side", F.when(missing, F.col("__lone_side"))).groupBy(*keys, "__alone", "__lone_side").agg(
        *[F.sum(f"n_{s}").alias(f"n_{s}") for s in ("base", "target")],
        *[F.max(f"{c}_{s}").alias(f"{c}_{s}") for c in columns for s in ("base", "target")])
    return whole.drop("__alone", "__lone_side"), within.drop("__alone", "__lone_side")


def _unique() -> Column:
    return (F.col("n_base") <= 1) & (F.col("n_target") <= 1)


def with_equality(pairs: DataFrame, columns: Sequence[str], tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``<c>_diff`` for numbers and ``<c>_eq`` to ``paired`` rows; see ``compare_rows``."""
    new = {}
    for c in columns:
        a, b = F.col(f"{c}_base"), F.col(f"{c}_target")
        if _kind(pairs.schema[f"{c}_base"].dataType) == "number":
            new[f"{c}_diff"] = a - b
            same = same_within(a, b, tolerance)
        else:
            same = same_text(a, b)
        new[f"{c}_eq"] = F.when(_unique(), same).otherwise(0)
    return pairs.withColumns(new)


def compare_rows(base: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 tolerance: float = TOLERANCE) -> DataFrame:
    """Keys, both values, ``<c>_diff`` for numbers and ``<c>_eq`` per column.

    Equal means: both null, the same text, or numbers within the tolerance.  NaN equals
    nothing.  A key on one side only has nulls on the other, so its columns are equal where the
    existing value is null too.
    """
    return with_equality(paired(base, target, keys, columns), columns, tolerance)


#: Blocks of keys a month in the first level of a digest comparison, and parts a differing block is cut into.
BLOCKS, PARTS = 256, 64


def block_digests(base: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                  blocks: Column, month: str | None = None) -> DataFrame:
    """(month, block, n_base, n_target, same): digests of both tables by block of keys, in one aggregate.

    A digest is the exact sum of the 64-bit hashes of the rows, so that order and partitions don't matter, and repeated
    rows count as often as they occur. Both sides need the same types, or numbers of any type, which are hashed as doubles.
    """
    by = ["block", *([month] if month else [])]
    kept = [*dict.fromkeys([*keys, *([month] if month else [])])]
    both = _stacked(base, target, kept, [c for c in columns if c not in kept]).withColumn("block", blocks)
    row = F.xxhash64(*kept, *[c for c in columns if c not in kept]).cast("decimal(20,0)")
    here = {"base": F.col("__side") == 0, "target": F.col("__side") == 1}
    counted = both.groupBy(*by).agg(
        *[F.count_if(p).alias(f"n_{s}") for s, p in here.items()],
        *[F.coalesce(F.sum(F.when(p, row)), F.lit(0).cast("decimal(38,0)")).alias(f"__{s}") for s, p in here.items()])
    same = (F.col("n_base") == F.col("n_target")) & (F.col("__base") == F.col("__target"))
    return counted.select(*by, "n_base", "n_target", same.alias("same"))


def differing_parts(base: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                    month: str | None = None, blocks: int = BLOCKS, parts: int = PARTS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base rows, target rows, report) after a digest tree of two levels: blocks of keys, then parts of those that differ.

    Only rows of differing parts are left, for a comparison that shuffles no others. The tables are read for the digests,
    whose shuffle is a row a block and task, and read again for the rows of blocks that differ. ``report`` has a row a
    month and block: n_base, n_target, same. Rows whose key has a null have a block like others.
    """
    key = F.xxhash64(*keys)
    block, part = F.pmod(key, F.lit(blocks)), F.pmod(F.shiftrightunsigned(key, 24), F.lit(parts))
    report = staged(block_digests(base, target, keys, columns, block, month), "digests")

    def within(df: DataFrame, listed: DataFrame, number: Column) -> DataFrame:
        found = listed.select(F.col("block").alias("__block"), *([F.col(month).alias("__month")] if month else []))
        same = number == F.col("__block")
        if month:
            same = same & F.col(month).eqNullSafe(F.col("__month"))
        return df.join(found, same, "left_semi")

    changed_blocks = report.where(~F.col("same"))
    left, right = within(base, changed_blocks, block), within(target, changed_blocks, block)
    both = block * parts + part
    finer = staged(block_digests(left, right, keys, columns, both, month), "digests")
    changed_parts = finer.where(~F.col("same"))
    return within(base, changed_parts, both), within(target, changed_parts, both), report


def match_summary(compared: DataFrame, columns: Sequence[str], pass_pct: float = PASS_PCT,
                  by: Sequence[str] = ()) -> DataFrame:
    """(by..., variable, count_0, count_1, match_pct, passed), one aggregate for all columns."""
    wide = compared.groupBy(*by).agg(F.count("*").alias("__n"),
                                     *[F.sum(f"{c}_eq").alias(c) for c in columns])
    long = wide.unpivot([*by, "__n"], list(columns), "variable", "count_1")
    pct = F.round(F.lit(100.0) * F.col("count_1") / F.col("__n"), 6)
    return long.select(*by, "variable", (F.col("__n") - F.col("count_1")).alias("count_0"), "count_1",
                       pct.alias("match_pct"),
                       F.when(pct >= pass_pct, F.lit(1)).otherwise(F.lit(0)).alias("passed"))


def key_overlap(compared: DataFrame) -> DataFrame:
    """One row: keys on both sides, on one side only, and repeated keys."""
    b, t = F.col("n_base") > 0, F.col("n_target") > 0
    return compared.agg(F.count_if(b & t).alias("n_both"), F.count_if(b & ~t).alias("only_base"),
                        F.count_if(t & ~b).alias("only_target"),
                        F.count_if(~_unique()).alias("n_repeated"))


def compare_tables(base: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   tolerance: float = TOLERANCE, require_equal_counts: bool = True
                   ) -> tuple[DataFrame, DataFrame, list[tuple[str, str]]]:
    """Compared rows, match summary and the columns that could not be compared.

    ``require_equal_counts`` raises when the tables differ in size, before comparing.
    """
    if require_equal_counts:
        n_base, n_target = base.count(), target.count()
        if n_base != n_target:
            raise ValueError(f"row counts differ: base={n_base}, target={n_target}")
    ok, skipped = comparable(base, target, columns)
    rows = compare_rows(base, target, keys, ok, tolerance)
    return rows, match_summary(rows, ok), skipped


def compare_common(base: DataFrame, target: DataFrame, keys: Sequence[str], exclude: Sequence[str] = (),
                   tolerance: float = TOLERANCE) -> DataFrame:
    """Match summary of all common columns over the keys present on both sides."""
    ok, _ = comparable(base, target, common_columns(base, target, keys, exclude))
    rows = compare_rows(base, target, keys, ok, tolerance)
    return match_summary(rows.filter((F.col("n_base") > 0) & (F.col("n_target") > 0)), ok)


def equality_report(joined: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row: total, and ``<name>_ok`` / ``<name>_no`` per (name, left column, right column)."""
    aggs = [F.count("*").alias("total")]
    for name, a, b in pairs:
        same = F.col(a).eqNullSafe(F.col(b))
        aggs += [F.count_if(same).alias(f"{name}_ok"), F.count_if(~same).alias(f"{name}_no")]
    return joined.agg(*aggs)


def differing_rows(joined: DataFrame, pairs: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rows where at least one pair differs (null equals null)."""
    any_diff = F.lit(False)
    for _, a, b in pairs:
        any_diff = any_diff | ~F.col(a).eqNullSafe(F.col(b))
    return joined.filter(any_diff)


def compare_schemas(base: T.StructType, target: T.StructType, spark: SparkSession) -> DataFrame:
    """(column, difference, base_value, target_value); schemas are small, so this runs on the driver."""
    a, b = {f.name: f for f in base.fields}, {f.name: f for f in target.fields}
    rows = []
    for name in sorted(a.keys() | b.keys()):
        if name not in a:
            rows.append((name, "only_target", None, b[name].dataType.simpleString()))
        elif name not in b:
            rows.append((name, "only_base", a[name].dataType.simpleString(), None))
        else:
            if a[name].dataType != b[name].dataType:
                rows.append((name, "type", a[name].dataType.simpleString(), b[name].dataType.simpleString()))
            if a[name].nullable != b[name].nullable:
                rows.append((name, "nullable", str(a[name].nullable).lower(), str(b[name].nullable).lower()))
    return spark.createDataFrame(rows, "column string, difference string, base_value string, target_value string")


def column_changes(base_columns: Sequence[str], target_columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns kept, added and removed between two tables."""
    a, b = set(base_columns), set(target_columns)
    return {"common": sorted(a & b), "added": sorted(b - a), "removed": sorted(a - b)}


def null_rates(df: DataFrame, columns: Sequence[str], out: str = "null_pct") -> DataFrame:
    """(variable, null rate in percent), one aggregate for all columns."""
    wide = df.agg(*[(F.lit(100.0) * F.count_if(F.col(c).isNull()) / F.count("*")).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "variable", out)


def compare_null_rates(base: DataFrame, target: DataFrame, columns: Sequence[str],
                       limit: float = 1.0) -> DataFrame:
    """Null rates of both tables and 1 where they are more than ``limit`` points apart."""
    both = null_rates(base, columns, "base_pct").join(null_rates(target, columns, "target_pct"), "variable")
    return both.withColumn("differs", F.when(F.abs(F.col("base_pct") - F.col("target_pct")) > limit, 1).otherwise(0))


def score_differences(base: DataFrame, target: DataFrame, keys: Sequence[str], score: str,
                      tolerances: Sequence[float] = (1e-6, 1e-4)) -> DataFrame:
    """One row over the common keys: n, mean and largest difference, matches per tolerance."""
    rows = paired(base, target, keys, [score]).filter((F.col("n_base") > 0) & (F.col("n_target") > 0))
    gap = F.abs(F.col(f"{score}_base") - F.col(f"{score}_target"))
    return rows.agg(F.count("*").alias("n"), F.avg(gap).alias("mean_diff"), F.max(gap).alias("max_diff"),
                    *[F.count_if(gap <= t).alias(f"matches_{i + 1}") for i, t in enumerate(tolerances)])


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """One row: total, nulls, smallest, largest and mean score."""
    return df.agg(F.count("*").alias("total"), F.count_if(F.col(score).isNull()).alias("n_null"),
                  F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"))


def compare_averages(base: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(variable, avg_base, avg_target), one pass over each table."""
    def means(df: DataFrame, out: str) -> DataFrame:
        wide = df.agg(*[F.avg(c).alias(c) for c in columns])
        return wide.unpivot([], list(columns), "variable", out)

    return means(base, "avg_base").join(means(target, "avg_target"), "variable")

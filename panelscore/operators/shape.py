"""Projections and schema shaping.  Every function is one projection, no data movement."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def rename_safe(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by dict; absent columns and identities are ignored."""
    present = {old: new for old, new in names.items() if old in df.columns and old != new}
    return df.withColumnsRenamed(present) if present else df


def short_names(columns: Sequence[str], max_length: int = 22) -> dict[str, str]:
    """Column -> name of at most ``max_length`` characters.

    Long names lose their tail and get ``_000``, ``_001`` ... in order of appearance; names that
    collide when case is ignored are numbered as well.
    """
    stems = [c if len(c) <= max_length else c[:max_length - 4] for c in columns]
    total: dict[str, int] = {}
    for s in stems:
        total[s.lower()] = total.get(s.lower(), 0) + 1
    seen: dict[str, int] = {}
    out = {}
    for column, stem in zip(columns, stems):
        nth = seen.get(stem.lower(), 0)
        seen[stem.lower()] = nth + 1
        unchanged = stem == column and total[stem.lower()] == 1
        out[column] = column if unchanged else f"{stem}_{nth:03d}"
    return out


def shorten_names(df: DataFrame, max_length: int = 22) -> tuple[DataFrame, DataFrame]:
    """Frame with short names, and the mapping as rows (variable, new_name)."""
    mapping = short_names(df.columns, max_length)
    spark: SparkSession = df.sparkSession
    pairs = spark.createDataFrame(list(mapping.items()), "variable string, new_name string")
    return df.toDF(*[mapping[c] for c in df.columns]), pairs


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def prefixed(df: DataFrame, source: str, keys: Iterable[str]) -> DataFrame:
    """``SOURCE__column`` for all columns but the keys."""
    keep = set(keys)
    return df.select(*[_q(c) if c in keep else _q(c).alias(f"{source}__{c}") for c in df.columns])


def contract(df: DataFrame, keys: Sequence[str], features: Sequence[str],
             missing: str = "null", feature_type: str = "double") -> DataFrame:
    """Keys and features in contract order.

    A missing feature becomes a typed null (``missing="null"``), is left out (``"drop"``) or is an
    error (``"error"``).
    """
    present = set(df.columns)
    absent = [c for c in features if c not in present]
    if absent and missing == "error":
        raise ValueError(f"missing features: {absent}")
    out = [_q(k) for k in keys if k in present]
    for c in features:
        if c in present:
            out.append(_q(c))
        elif missing == "null":
            out.append(F.lit(None).cast(feature_type).alias(c))
    return df.select(*out)


def align_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.select(*[_q(c).cast(types[c]).alias(c) if c in types else _q(c) for c in df.columns])


def as_double(df: DataFrame, kind: str = "decimal") -> DataFrame:
    """Columns whose type name begins with ``kind`` as double."""
    return align_types(df, {name: "double" for name, t in df.dtypes if t.startswith(kind)})


def to_double(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """All columns but ``keep`` as double; text that is not a number becomes null."""
    kept = set(keep)
    out = []
    for f in df.schema.fields:
        if f.name in kept:
            out.append(_q(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.trim(_q(f.name)).try_cast("double").alias(f.name))
        else:
            out.append(_q(f.name).cast("double").alias(f.name))
    return df.select(*out)


def with_literals(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def analysis_columns(df: DataFrame, control: Iterable[str], root: Sequence[str] = ()) -> list[str]:
    """Numeric columns to analyse: ``root`` columns first, control columns left out, case ignored."""
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    skip = {c.lower() for c in control}
    first = [by_lower[r.lower()].name for r in root if r.lower() in by_lower]
    taken = skip | {c.lower() for c in first}
    rest = [f.name for f in df.schema.fields
            if f.name.lower() not in taken and isinstance(f.dataType, T.NumericType)]
    return first + rest


def pack(df: DataFrame, root: dict[str, tuple[str, str | None]], struct_name: str,
         field_types: dict[str, str] | None = None, stamps: dict[str, Column] | None = None) -> DataFrame:
    """Published layout: root columns, stamps, and one struct holding everything else.

    ``root`` maps target name -> (source column, type or None).  An absent source gives a null.
    ``field_types`` casts struct fields; a floating number meant to be text is cut to its whole
    part first, so ``1.0`` is published as ``"1"``.
    """
    df = lower_names(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for target, (source, kind) in root.items():
        if source in types:
            c = _q(source)
            out.append((c.cast(kind) if kind else c).alias(target))
        else:
            out.append(F.lit(None).cast(kind or "string").alias(target))
    for name, expr in (stamps or {}).items():
        out.append(expr.alias(name))
    used = {source for source, _ in root.values()}
    fields = []
    for name, kind in types.items():
        if name in used:
            continue
        c, target = _q(name), (field_types or {}).get(name)
        if target == "string" and isinstance(kind, (T.DoubleType, T.FloatType)):
            c = c.cast("int").cast("string")
        elif target:
            c = c.cast(target)
        fields.append(c.alias(name))
    body = F.struct(*fields) if fields else F.lit(None)
    return df.select(*out, body.alias(struct_name))


def flatten(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Fields of the first candidate struct that exists become columns; otherwise unchanged."""
    for name in candidates:
        if name in df.columns and isinstance(df.schema[name].dataType, T.StructType):
            return df.select(*[_q(c) for c in df.columns if c != name], F.col(f"`{name}`.*"))
    return df

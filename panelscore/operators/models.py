"""Model scoring: linear models as expressions, models as tables, and vectorised Python models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.functions.scoring import inverse_logit

INTERCEPT = "(intercept)"
MAX_MODEL_ROWS = 100_000


def require_features(df: DataFrame, features: Sequence[str]) -> None:
    """Raise when a model feature is missing from the table."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing features: {absent}")


def linear_predictor(coefficients: Mapping[str, float]) -> Column:
    """Intercept plus weighted sum; a null feature makes the result null."""
    total = F.lit(float(coefficients.get(INTERCEPT, 0.0)))
    for feature, weight in coefficients.items():
        if feature != INTERCEPT:
            total = total + F.lit(float(weight)) * F.col(feature).cast("double")
    return total


def read_coefficients(model: DataFrame) -> dict[str, float]:
    """Model table (feature, coefficient) -> dict.  One row per feature, checked before it is taken
    to the driver; a repeated feature is an error."""
    rows = model.select("feature", "coefficient").limit(MAX_MODEL_ROWS + 1).collect()
    if len(rows) > MAX_MODEL_ROWS:
        raise ValueError("model table too large for a coefficient table")
    out = {r["feature"]: r["coefficient"] for r in rows}
    if len(out) != len(rows) or not rows:
        raise ValueError("model table is empty or repeats a feature")
    return out


def score_linear(df: DataFrame, model: DataFrame | Mapping[str, float], out: str = "pd_raw") -> DataFrame:
    """Logistic model given as a dict or as a table, evaluated as one generated expression."""
    coefficients = model if isinstance(model, Mapping) else read_coefficients(model)
    require_features(df, [f for f in coefficients if f != INTERCEPT])
    return df.withColumn(out, inverse_logit(linear_predictor(coefficients)))


def score_vectorised(df: DataFrame, features: Sequence[str], predict: Callable[[pd.DataFrame], np.ndarray],
                     out: str = "pd_raw") -> DataFrame:
    """Any model with a batch ``predict``: features are cast to double, in model order.

    The model travels with the function; batches arrive through Arrow and partitions are scored
    independently, without a shuffle.
    """
    require_features(df, features)
    names = list(features)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            if len(batch) == 0:
                yield pd.Series([], dtype="float64")
            else:
                yield pd.Series(np.asarray(predict(batch[names]), dtype="float64"))

    packed = F.struct(*[F.col(c).cast("double").alias(c) for c in names])
    return df.withColumn(out, score(packed))


def score_trees(df: DataFrame, nodes: Sequence[Mapping], features: Sequence[str], out: str = "pd_raw") -> DataFrame:
    """Additive trees given as rows (tree, node, feature, threshold, yes, no, value).

    Node 0 is the root; ``value <= threshold`` goes to ``yes``, everything else, nulls included, to
    ``no``; a row without feature is a leaf.  The leaf values are summed and passed through the
    inverse logit.  A tree becomes one nested expression, which stays inside generated code.
    """
    require_features(df, features)
    trees: dict[int, dict[int, Mapping]] = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["node"]] = n

    def below(tree: Mapping[int, Mapping], number: int) -> Column:
        n = tree[number]
        if n["feature"] is None:
            return F.lit(float(n["value"]))
        low = F.col(n["feature"]).cast("double") <= F.lit(float(n["threshold"]))
        return F.when(low, below(tree, n["yes"])).otherwise(below(tree, n["no"]))

    total = F.lit(0.0)
    for tree in trees.values():
        total = total + below(tree, 0)
    return df.withColumn(out, inverse_logit(total))


def score_segments(df: DataFrame, segments: Sequence[tuple[int, Column | str, Mapping[str, float]]],
                   out: str = "pd_raw") -> DataFrame:
    """Segment-routed linear models: (segment id, filter, coefficients).

    Filters are evaluated in order and a row goes to the first one it meets, in a single pass over
    the table; rows that meet none are left out.
    """
    def cond(c):
        return F.expr(c) if isinstance(c, str) else c

    chosen, value = F.lit(None).cast("int"), F.lit(None).cast("double")
    for segment_id, rule, coefficients in reversed(list(segments)):
        require_features(df, [f for f in coefficients if f != INTERCEPT])
        chosen = F.when(cond(rule), F.lit(segment_id)).otherwise(chosen)
        value = F.when(cond(rule), inverse_logit(linear_predictor(coefficients))).otherwise(value)
    return df.withColumns({"segment_id": chosen, out: value}).filter(F.col("segment_id").isNotNull())


def score_segment_tables(df: DataFrame, segments: Sequence[tuple[int, Column | str]],
                         score: Callable[[int, DataFrame], DataFrame]) -> DataFrame:
    """Segments whose models are not expressions: filter, score each, stack by name."""
    parts = []
    for segment_id, rule in segments:
        rows = df.filter(F.expr(rule) if isinstance(rule, str) else rule)
        parts.append(score(segment_id, rows.withColumn("segment_id", F.lit(segment_id))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def score_routed(df: DataFrame, models: Sequence[tuple[int, Column | str, Sequence[str], Callable[[pd.DataFrame], np.ndarray]]],
                 overlap: str = "first", out: str = "pd_raw") -> DataFrame:
    """Several Python models in one Arrow pass: (segment id, filter, features, predict) each.

    Rows travel to Python once, with the features of all models; each batch is cut by segment, scored by the segment's
    model and put back in order. ``overlap`` "first" gives a row to the first filter it meets, "all" returns it once for
    every filter it meets, in order of the models. Rows that meet none, nulls in a filter included, are left out.
    """
    if overlap not in ("first", "all"):
        raise ValueError("overlap must be 'first' or 'all'")
    features = list(dict.fromkeys(f for _, _, names, _ in models for f in names))
    require_features(df, features)
    number = {segment_id: (list(names), predict) for segment_id, _, names, predict in models}
    if len(number) != len(models):
        raise ValueError("segment ids repeat")

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.full(len(batch), np.nan)
            for segment_id, rows in batch.groupby("__segment").indices.items():
                names, predict = number[segment_id]
                found[rows] = np.asarray(predict(batch[names].iloc[rows]), dtype="float64")
            yield pd.Series(found).where(~np.isnan(found))

    met = F.array_compact(F.array(*[
        F.when(F.expr(rule) if isinstance(rule, str) else rule, F.lit(segment_id)) for segment_id, rule, _, _ in models]))
    chosen = met if overlap == "all" else F.slice(met, 1, 1)
    routed = df.withColumn("segment_id", F.explode(chosen))
    packed = F.struct(F.col("segment_id").alias("__segment"), *[F.col(c).cast("double").alias(c) for c in features])
    return routed.withColumn(out, score(packed))

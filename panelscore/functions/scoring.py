"""From probability to log-odds, calibrated probability, points and bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scale of the score points and cut points of the published distributions.
POINTS_OFFSET, POINTS_FACTOR, POINTS_FLOOR = 174.25, 57.708, 3.0
PD_CUTS = (0.01, 0.03, 0.07, 0.15, 0.30)
BAND_CUTS = (0.02, 0.07)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_odds(p) -> Column:
    """``ln(p / (1 - p))``; null at 0, at 1 and outside."""
    v = _col(p)
    return F.log(F.try_divide(v, F.lit(1.0) - v))


def linear(x, intercept: float, slope: float) -> Column:
    return F.lit(float(intercept)) + F.lit(float(slope)) * _col(x)


def inverse_logit(x) -> Column:
    """``1 / (1 + exp(-x))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(x)))


def points(x, offset: float = POINTS_OFFSET, factor: float = POINTS_FACTOR,
           floor: float = POINTS_FLOOR, digits: int = 0) -> Column:
    """``max(floor, round(offset - factor * x))``; null log-odds stay null."""
    v = _col(x)
    return F.when(v.isNotNull(),
                  F.greatest(F.lit(float(floor)), F.round(F.lit(offset) - F.lit(factor) * v, digits)))


def risk_band(p, cuts: Sequence[float] = BAND_CUTS,
              labels: Sequence[str] = ("low", "watch", "high"), null_band: str | None = None) -> Column:
    """Label of the first cut above p.  An unknown p falls into the last band unless
    ``null_band`` names another one."""
    v = _col(p)
    expr = F.when(v.isNull(), F.lit(labels[-1] if null_band is None else null_band))
    for cut, label in zip(cuts, labels):
        expr = expr.when(v < F.lit(float(cut)), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def bucket_labels(cuts: Sequence[float] = PD_CUTS) -> list[str]:
    """Labels in report order, the null bucket first."""
    edges = [f"{e:.2f}" for e in (0.0, *cuts)] + ["∞"]
    return ["C0: NULL"] + [f"C{i + 1}: [{edges[i]}, {edges[i + 1]}]" for i in range(len(edges) - 1)]


def pd_bucket(p, cuts: Sequence[float] = PD_CUTS) -> Column:
    """Half-open buckets from 0 upwards; nulls ``C0``, values below 0 ``C?``."""
    v = _col(p)
    labels = bucket_labels(cuts)
    expr = F.when(v.isNull(), F.lit(labels[0])).when(v < 0, F.lit("C?"))
    for cut, label in zip(cuts, labels[1:]):
        expr = expr.when(v < F.lit(float(cut)), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))

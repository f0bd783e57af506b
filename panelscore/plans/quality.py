"""The quality job of a scored table: one month against its history, for the whole table or by segment.

The month range is staged once in the shared folder; every metric table reads the staged rows. All segments are computed
in the same aggregates, so their number does not add scans.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.operators import drift, profile
from panelscore.session import new_folder
from panelscore.sources.sinks import stage

#: Yellow from, red from, per metric of the profile; a light for each.
LIGHTS = {"null_pct": profile.NULL_PCT_LIGHT, "zero_pct": (50.0, 90.0)}


class Metrics:
    """The metric tables of one run over the staged rows, each built when it is asked for."""

    NAMES = ("keys", "profile", "evolution", "histogram", "scores", "drift", "kpis")

    def __init__(self, rows: DataFrame, current: int, columns: Sequence[str], key: str,
                 scores: Mapping[str, Sequence[float]], month: str, by: Sequence[str]):
        self._rows, self._columns, self._key, self._cuts, self._month, self._by = rows, columns, key, scores, month, by
        self._now, self._before = rows.where(F.col(month) == current), rows.where(F.col(month) < current)

    @cached_property
    def keys(self) -> DataFrame:
        return profile.key_check(self._now, self._key, by=self._by)

    @cached_property
    def profile(self) -> DataFrame:
        return with_lights(profile.variable_profile(self._now, self._columns, by=self._by))

    @cached_property
    def evolution(self) -> DataFrame:
        return profile.moments(self._rows, self._columns, [*self._by, self._month])

    @cached_property
    def histogram(self) -> DataFrame:
        return profile.histogram(self._now, self._columns, by=self._by)

    @cached_property
    def scores(self) -> DataFrame:
        return score_distribution(self._rows, self._cuts, self._month, self._by)

    @cached_property
    def drift(self) -> DataFrame:
        return drift.drift(self._before, self._now, self._columns, by=self._by)

    @cached_property
    def kpis(self) -> DataFrame:
        """Variables per segment, and how many of them have each light."""
        return self.profile.groupBy(*self._by).agg(F.count("*").alias("n_variables"), *[
            F.count_if(F.col("light") == c).alias(c) for c in ("green", "yellow", "red")])

    def frames(self) -> Mapping[str, DataFrame]:
        """By name, for ``sinks.write_metrics``."""
        return {name: getattr(self, name) for name in self.NAMES}


def with_lights(metrics: DataFrame, lights: Mapping[str, tuple[float, float]] = LIGHTS) -> DataFrame:
    """Adds ``<metric>_light`` for each metric with thresholds, and ``light``, the worst of them."""
    names = [f"{m}_light" for m in lights]
    lit = metrics.drop("null_light").withColumns({f"{m}_light": profile.light(m, *t) for m, t in lights.items()})

    def any_is(colour: str) -> Column:
        found = F.lit(False)
        for n in names:
            found = found | (F.col(n) == colour)
        return found
    return lit.withColumn("light", F.when(any_is("red"), "red").when(any_is("yellow"), "yellow").otherwise("green"))


def score_distribution(rows: DataFrame, scores: Mapping[str, Sequence[float]], month: str = "month",
                       by: Sequence[str] = ()) -> DataFrame:
    """Buckets per month of every score column, each with its own cuts, current months and history alike."""
    parts = [profile.buckets_by_month(rows, s, month, cuts, by).withColumn("score", F.lit(s)) for s, cuts in scores.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run(rows: DataFrame, current: int, columns: Sequence[str], key: str, scores: Mapping[str, Sequence[float]],
        month: str = "month", by: Sequence[str] = (), staged: str | None = None) -> Metrics:
    """All metric tables for the month ``current``; ``rows`` has the current and earlier months."""
    kept = rows.where(F.col(month) <= current).select(*dict.fromkeys([*by, month, key, *columns, *scores]))
    kept = stage(kept, staged or new_folder(rows.sparkSession, "quality"))
    return Metrics(kept, current, columns, key, scores, month, by)

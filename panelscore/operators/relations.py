"""Related parties: which owner represents a company, and the owner's variables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscore.operators.joins import lookup_join


def canonical_owner(owners: DataFrame, party: str, related: str, is_company: Column,
                    by: Sequence[str] = ()) -> DataFrame:
    """One owner per party (and ``by``): a person owns itself, a company takes its largest owner id."""
    chosen = F.when(is_company, F.col(related)).otherwise(F.col(party))
    return owners.groupBy(*by, party).agg(F.max(chosen).alias(related))


def flag_chosen(rows: DataFrame, chosen: DataFrame, on: Sequence[str], flag: str = "is_chosen") -> DataFrame:
    """1 on the rows whose key pair is the chosen one of its group, else 0."""
    marked = chosen.select(*on).distinct().withColumn(flag, F.lit(1))
    return rows.join(marked, on=list(on), how="left").withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))


def chosen_owner_pairs(owners: DataFrame, party: str, related: str, is_company: Column,
                       by: Sequence[str] = ()) -> DataFrame:
    """(by..., party, owner) for the parties whose canonical owner really occurs among their relations.

    Equal to canonical_owner -> flag_chosen -> keep flagged -> distinct, without joining the
    relation table to itself: the chosen id is a relation row exactly when it is the largest
    related id of a company row, or the party itself and a self relation exists.
    """
    p, r = F.col(party), F.col(related)
    per_party = owners.groupBy(*by, party).agg(
        F.max(F.when(is_company, r).otherwise(p)).alias("__chosen"),
        F.max(F.when(is_company, r)).alias("__owner"),
        F.max(F.when(p == r, F.lit(1))).alias("__self"))
    occurs = ((F.col("__chosen") == F.col("__owner"))
              | ((F.col("__chosen") == p) & (F.col("__self") == 1)))
    return per_party.filter(occurs).select(*by, party, F.col("__chosen").alias(related))


def owner_values(pairs: DataFrame, values: DataFrame, party: str, related: str, columns: Sequence[str],
                 suffix: str = "_owner", by: Sequence[str] = ()) -> DataFrame:
    """The owner's variables next to the party; ``values`` is keyed by ``by`` and ``party``.

    One person may own a large part of all companies, so frequent owners are left to AQE, which splits them.
    """
    owner_side = values.select(*by, F.col(party).alias(related),
                               *[F.col(c).alias(c + suffix) for c in columns])
    return (lookup_join(pairs, owner_side, [*by, related], "left")
            .select(*by, party, *[c + suffix for c in columns]))

"""From which month does a target table take a variable?

A key is a voter for a variable if its source value is known in every candidate month and not the same in all of them. It
votes for the months whose value the target has. A variable nobody can vote on is ambiguous.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscore.functions.features import changed


def lag_trace(source: DataFrame, target: DataFrame, key: str, value: str, target_value: str,
              previous: int, process: int, month: str = "month") -> DataFrame:
    """(verdict, n) over the keys whose source value changed between the two months.

    ``previous`` / ``process``: the target holds that month's value; ``none``: neither.  No row at
    all means the variable cannot be told apart.  Both source months are read in one aggregate.
    """
    m, v = F.col(month), F.col(value)
    two = (source.filter(m.isin(int(previous), int(process))).groupBy(key)
           .agg(F.max(F.when(m == previous, v)).alias("__before"), F.max(F.when(m == process, v)).alias("__after"))
           .filter(changed("__before", "__after")))
    found = target.filter(m == process).select(key, F.col(target_value).alias("__target"))
    t = F.col("__target")
    verdict = (F.when(t == F.col("__before"), F.lit("previous"))
               .when(t == F.col("__after"), F.lit("process")).otherwise(F.lit("none")))
    return (two.join(found, key, "inner").withColumn("verdict", verdict)
            .groupBy("verdict").agg(F.count("*").alias("n")))


def lag_evidence(source: DataFrame, target: DataFrame, key: str, variables: Mapping[str, tuple[str, str]],
                 candidates: Sequence[int], process: int, month: str = "month") -> DataFrame:
    """(variable, candidate, voters, votes, share, verdict), a row for each variable and candidate month.

    ``variables`` maps a name to its (source column, target column). ``verdict`` is the month with the most votes as text;
    ``none`` if the voters agree with no month, ``ambiguous`` if there is no voter or two months have the most votes. All
    variables and months are counted in one aggregate over one join: both tables are read once, and a key is one row. A
    source key that repeats within a month has its largest value; a target key that repeats votes once for each row.
    """
    months, m = [int(c) for c in candidates], F.col(month)
    if not months or not variables:
        raise ValueError("variables and candidate months are needed")
    number = {name: i for i, name in enumerate(variables)}
    wide = source.filter(m.isin(months)).groupBy(key).agg(*[
        F.max(F.when(m == c, F.col(variables[v][0]))).alias(f"__{i}_{c}") for v, i in number.items() for c in months])
    found = target.filter(m == process).select(key, *[F.col(variables[v][1]).alias(f"__t{i}") for v, i in number.items()])

    def votes(i: int) -> list:
        values = [F.col(f"__{i}_{c}") for c in months]
        voter = F.lit(False)
        for v in values[1:]:
            voter = voter | (v != values[0])
        for v in values:
            voter = voter & v.isNotNull()
        return [F.count_if(voter).alias(f"__v{i}"), *[
            F.count_if(voter & (v == F.col(f"__t{i}"))).alias(f"__{i}_{c}") for v, c in zip(values, months)]]

    counts = wide.join(found, key, "inner").agg(*[a for i in number.values() for a in votes(i)])

    def rows(name: str, i: int) -> list:
        each = {c: F.col(f"__{i}_{c}") for c in months}
        most = F.greatest(*each.values()) if len(months) > 1 else each[months[0]]
        ties = sum((F.when(v == most, 1).otherwise(0) for v in each.values()), F.lit(0))
        best = F.coalesce(*[F.when(v == most, F.lit(str(c))) for c, v in each.items()])
        verdict = (F.when(F.col(f"__v{i}") == 0, F.lit("ambiguous")).when(most == 0, F.lit("none"))
                   .when(ties > 1, F.lit("ambiguous")).otherwise(best))
        return [F.struct(F.lit(name).alias("variable"), F.lit(c).alias("candidate"), F.col(f"__v{i}").alias("voters"),
                         v.alias("votes"), F.try_divide(v.cast("double"), F.col(f"__v{i}")).alias("share"),
                         verdict.alias("verdict")) for c, v in each.items()]

    return counts.select(F.explode(F.array(*[r for v, i in number.items() for r in rows(v, i)])).alias("r")).select("r.*")

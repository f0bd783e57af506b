"""Exact top-k search of binary codes by Hamming distance, by incremental multi-index hashing.

A code is cut into m segments. Of codes that differ in m * r + a bits or less, a < m, one of the first a + 1 segments differs
in r bits or less, or one of the others in r - 1 or less: looking up the segment values that near to the query's finds every
code up to that distance. Rounds widen the distance by about twice the look-ups and keep, in the join, the codes whose
verified distance is covered. A query whose k-th code is covered is closed; the rest goes on, at last to all values of one
segment, which meet every code, so that every result is exact. A round repeats the look-ups of smaller distances, which are fewer, instead of keeping
what is too far yet.

Scale: the number of segments follows the number of codes, so that a segment value has few codes. Equal codes are one
row of the index with a count; their ids are joined in the end. Of more than k ids of one code only the k smallest can
be results. A round deals out the queries, whose look-ups are many times their size, and is a merge join by (segment, value):
the look-ups are never broadcast, though Spark's estimate of them is no larger than the queries, and AQE splits hot values.
Then comes an aggregate by (query, code) and a window by query, of at most k rows a query and candidate code.

Defined results: null vectors have no code and are neither found nor queries. Ties in distance go to smaller ids. A query
finds itself unless ``with_self`` is false. With fewer than k other rows all are found. Rows that repeat id and vector are
found once; ids are integers. Other columns are neither read nor changed.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscore.llm.common import stage

BITS = 64


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """Signs of the first ``bits`` components, the first in the lowest bit; absent and null components give 0."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"), lambda code, i: F.when(
        F.coalesce(F.get(vector, i) > 0, F.lit(False)), code.bitwiseOR(F.call_function(
            "shiftleft", F.lit(1).cast("long"), i))).otherwise(code))


def segment_count(n: int) -> int:
    """Segments of 8 bits up to two thousand codes, of 13 up to half a million, and of 16 beyond: some ten codes a value."""
    return 8 if n < 1 << 11 else 5 if n < 1 << 19 else 4


def _widths(m: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    bounds = [BITS * i // m for i in range(m + 1)]
    return [(low, high - low) for low, high in zip(bounds, bounds[1:])]


def _keys(code: Column, m: int) -> list[Column]:
    """Segment and value as one number, so that joins compare and sort by one column."""
    return [F.shiftrightunsigned(code, low).bitwiseAND(F.lit((1 << w) - 1)).bitwiseOR(F.lit(i << 32))
            for i, (low, w) in enumerate(_widths(m))]


def rounds(m: int) -> list[tuple[int, list[int]]]:
    """(distance covered, radius of each segment) by growing distance; -1 looks nothing up.

    A round looks up about twice as many values as the one before. Where these are as many as a segment has, the last round
    takes all values of the first segment and covers all distances.
    """
    widths = [w for _, w in _widths(m)]
    found, least = [], 0
    for covered in range(m - 1, BITS):
        r, a = divmod(covered, m)
        radii = [r - (i > a) for i in range(m)]
        n = sum(comb(w, bits) for w, radius in zip(widths, radii) for bits in range(radius + 1))
        if n >= 1 << widths[0]:
            break
        if n >= least:
            found.append((covered, radii))
            least = max(2 * n, 64)
    return [*found, (BITS, [widths[0]] + [-1] * (m - 1))]


def _looked_up(active: DataFrame, m: int, radii: list[int]) -> DataFrame:
    """A row of (q, ..) and the key for each value within the radius of the segments of q."""
    probed = [(key, w, r) for key, (_, w), r in zip(_keys(F.col("q"), m), _widths(m), radii) if r >= 0]
    kinds = sorted({(w, r) for _, w, r in probed})
    # at most 2^16 masks, a constant of the plan
    masks = F.lit(None).cast("array<bigint>")
    for nth, (w, r) in enumerate(kinds):
        of_kind = F.split(F.lit(",".join(str(x) for x in range(1 << w) if x.bit_count() <= r)), ",")
        masks = F.when(F.col("kind") == nth, of_kind.cast("array<bigint>")).otherwise(masks)
    probes = F.array(*[F.struct(key.alias("key"), F.lit(kinds.index((w, r))).alias("kind")) for key, w, r in probed])
    # the queries are a small file, one task's work, before their look-ups are spread out
    parts = int(active.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = active.columns
    return active.repartition(parts, "q").select(*given, F.explode(probes).alias("p")).select(*given, "p.*").select(
        *given, "key", F.explode(masks).alias("mask")).select(*given, F.col("key").bitwiseXOR(F.col("mask")).alias("key"))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 10, with_self: bool = False) -> DataFrame:
    """(query_id, rank, id, distance) for queries (id, code) against all rows (id, code)."""
    rows = rows.where("id is not null and code is not null")
    index = stage(rows.groupBy("code").agg(F.count_distinct("id").alias("n")), "search-codes")
    m = segment_count(index.count())
    segments = stage(index.select("code", "n", F.explode(F.array(*_keys(F.col("code"), m))).alias("key")), "search-index")
    wanted = queries.where("id is not null and code is not null").select("id", "code").distinct()
    # equal queries of different ids search once, for one more row, since each may leave itself out
    need = k + (0 if with_self else 1)
    active = stage(wanted.select(F.col("code").alias("q")).distinct(), "search-queries")
    done = []
    # rows of nearer codes come before; codes of the nearest distances whose rows reach ``need`` are wanted, and all codes of
    # the last distance stay, for ties
    nearer = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(nearer), F.lit(0))
    distance = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
    for covered, radii in rounds(m):
        far = F.lit(covered)
        if covered == BITS:
            # the look-ups meet every code: how far each query has to go is counted first, so that no more pairs are kept
            counts = _looked_up(active, m, radii).join(segments.hint("merge"), "key").groupBy(
                "q", distance.alias("distance")).agg(F.sum("n").alias("n"))
            active = stage(counts.withColumn("before", before).where(F.col("before") < need).groupBy("q").agg(
                F.max("distance").alias("far")), "search-queries")
            far = F.col("far")
        hits = _looked_up(active, m, radii).join(segments.hint("merge"), "key").where(distance <= far).select(
            "q", "code", "n", distance.alias("distance")).distinct()
        kept = stage(hits.withColumn("before", before).where(F.col("before") < need).drop("before"), "search-found")
        if covered == BITS:
            done.append(kept)
            break
        closed = kept.groupBy("q").agg(F.sum("n").alias("n")).where(F.col("n") >= need).select("q")
        done.append(kept.join(closed, "q", "left_semi"))
        active = stage(active.join(closed, "q", "left_anti"), "search-queries")
        if active.isEmpty():
            break
    nearest = done[0]
    for part in done[1:]:
        nearest = nearest.unionByName(part)
    nearest = stage(nearest, "search-nearest")
    ids = rows.select("id", "code").distinct().withColumn("nth", F.row_number().over(
        Window.partitionBy("code").orderBy("id"))).where(F.col("nth") <= need).select("id", "code")
    # few rows a code and few codes a query: rank them all
    paired = nearest.join(ids, "code").select("q", "id", "distance")
    order = Window.partitionBy("q").orderBy("distance", "id")
    ranked = paired.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= need)
    named = ranked.join(wanted.select(F.col("id").alias("query_id"), F.col("code").alias("q")), "q")
    if not with_self:
        named = named.where("id <> query_id")
    final = Window.partitionBy("query_id").orderBy("distance", "id")
    return named.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select(
        "query_id", "rank", "id", "distance")

"""Operators on small fixtures, checked by brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelscore.operators import (arrears, certify, compare, densify, drift, enrich, joins, models, profile, ranks, sketches,
                                  relations, rollup, shape, trace)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


# ---- shape -----------------------------------------------------------------------------------


def test_short_names():
    got = shape.short_names(["short", "a_very_long_column_name_one", "a_very_long_column_name_two", "Key", "KEY"], 22)
    assert got == {"short": "short", "a_very_long_column_name_one": "a_very_long_column_000",
                   "a_very_long_column_name_two": "a_very_long_column_001", "Key": "Key_000", "KEY": "KEY_001"}
    assert all(len(n) <= 22 for n in got.values())


def test_pack_and_flatten(spark):
    df = spark.createDataFrame([(202501, "p", 0.25, 1.0, 7)], "MONTH int, party string, pd double, flag double, n int")
    packed = shape.pack(df, {"party": ("party", "string"), "numpd": ("pd", "decimal(19,8)"), "extra": ("nope", "string"),
                             "month": ("month", "int")}, "vars", {"flag": "string", "n": "bigint"})
    assert packed.columns == ["party", "numpd", "extra", "month", "vars"]
    flat = shape.flatten(packed, ["other", "vars"])
    assert dict(flat.dtypes) == {"party": "string", "numpd": "decimal(19,8)", "extra": "string", "month": "int",
                                 "flag": "string", "n": "bigint"}
    r = flat.first()
    assert (r["flag"], r["n"], r["extra"], float(r["numpd"])) == ("1", 7, None, 0.25)
    assert shape.flatten(flat, ["vars"]).columns == flat.columns


def test_contract(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, a double")
    assert shape.contract(df, ["k"], ["b", "a"]).dtypes == [("k", "int"), ("b", "double"), ("a", "double")]
    assert shape.contract(df, ["k"], ["b", "a"], missing="drop").columns == ["k", "a"]
    with pytest.raises(ValueError):
        shape.contract(df, ["k"], ["b"], missing="error")


def test_analysis_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "Month int, a double, s string, NumPD double")
    assert shape.analysis_columns(df, ["MONTH"], ["numpd"]) == ["NumPD", "a"]


# ---- joins -----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows have one key, a third have none."""
    rnd = random.Random(5)
    data = [(7 if i % 3 == 0 else None if i % 3 == 1 else rnd.randrange(100), i) for i in range(3000)]
    return spark.createDataFrame(data, "k int, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_join_is_a_plain_join(spark, skewed, how):
    dim = spark.createDataFrame([(k, k * 10) for k in range(50)] + [(7, -1)], "k int, d int")
    got = joins.lookup_join(skewed, dim, ["k"], how)
    assert rows(got, "k", "v", "d") == rows(skewed.join(dim, "k", how), "k", "v", "d")


def test_left_lookup_keeps_and_spreads_null_keys(spark, skewed):
    dim = spark.createDataFrame([(k, k * 10) for k in range(50)], "k int, d int")
    got = joins.left_lookup(skewed, dim, ["k"], ["k"], ["v"])
    assert rows(got, "k", "v", "d") == rows(skewed.join(dim, "k", "left"), "k", "v", "d")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                             "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(before, ("-1", "false", "16")):
            spark.conf.set(key, value)
        got = joins.left_lookup(skewed, dim, ["k"], ["k"], ["v"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert all("__salt" in line for line in plan.split("\n") if "hashpartitioning" in line)
        alone = got.where("k is null").groupBy(F.spark_partition_id()).count().collect()
        assert len(alone) == 16 and max(r["count"] for r in alone) < 200
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_full_merge_keeps_whole_rows_and_null_keys_apart(spark):
    a = spark.createDataFrame([(1, 1, 2), (1, 9, None), (None, 3, 3), (None, 3, 3)], "k int, x int, z int")
    b = spark.createDataFrame([(1, "u"), (None, "v")], "k int, c string")
    assert rows(joins.full_merge([a, b], ["k"]), "k", "x", "z", "c") == rows(spark.createDataFrame(
        [(1, 9, None, "u"), (None, 3, 3, None), (None, 3, 3, None), (None, None, None, "v")],
        "k int, x int, z int, c string"), "k", "x", "z", "c")


def test_full_merge_is_an_outer_chain(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 6.0)], "k int, b double")
    c = spark.createDataFrame([(3, "x"), (4, "y")], "k int, c string")
    chain = a.join(b, "k", "full").join(c, "k", "full")
    assert rows(joins.full_merge([a, b, c], ["k"]), "k", "a", "b", "c") == rows(chain, "k", "a", "b", "c")


# ---- rollup ----------------------------------------------------------------------------------


def test_one_row_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, None, 5), (1, 2, 1), (1, 2, 3), (2, None, None)], "k int, a int, b int")
    want = [(1, 2, 3), (2, None, None)]
    assert rows(rollup.one_row_per_key(df, ["k"])) == want
    assert rows(rollup.one_row_per_key(df.repartition(3, "b"), ["k"])) == want


def test_top_n(spark, skewed):
    got = rollup.top_n_per_group(skewed, ["k"], [F.desc("v")], 4, ["v"], salts=5)
    groups = {}
    for k, v in rows(skewed):
        groups.setdefault(k, []).append(v)
    want = sorted(((k, v) for k, vs in groups.items() for v in sorted(vs)[-4:]), key=repr)
    assert rows(got, "k", "v") == want


def test_rollup_of_a_hot_customer(spark):
    data = [("hot", 202501, "1" if i % 2 else "0", float(i)) for i in range(2000)] + [("cold", 202501, "0", 5.0)]
    df = spark.createDataFrame(data, "party string, month int, valid string, balance double")
    got = rollup.rollup_accounts(df, ["party", "month"], F.col("valid") == "1", max_values={"top": "balance"},
                                 balances={"total": "balance"}, flags={"big": F.col("balance") > 1998}, all_suffix="_t")
    by = {r["party"]: r for r in got.collect()}
    assert by["hot"]["total"] == sum(range(1, 2000, 2)) and by["hot"]["total_t"] == sum(range(2000))
    assert (by["hot"]["big"], by["cold"]["big"], by["cold"]["is_valid"], by["cold"]["top"], by["cold"]["top_t"]) == (1, 0, 0, 0.0, 5.0)


# ---- enrichment ------------------------------------------------------------------------------


def test_enrich_keeps_rows_and_shifts_over_year_end(spark):
    base = spark.createDataFrame([(202501, "a", "u1"), (202501, "b", None), (202412, "a", "u1")], "month int, party string, uid string")
    src = spark.createDataFrame([(202412, "a", 1.0), (202412, "a", 3.0), (202501, "a", 9.0)], "month int, party string, x double")
    other = spark.createDataFrame([(202501, "u1", "z"), (202501, None, "never")], "month int, uid string, y string")
    got = enrich.enrich(base, [enrich.FeatureSource("s", src, {"x": "prev"}, "party", 1, serves=(202412, 202501)),
                               enrich.FeatureSource("o", other, ["y"], "uid", nullable_key=True)])
    assert rows(got) == sorted([(202501, "a", "u1", 3.0, "z"), (202501, "b", None, None, None), (202412, "a", "u1", None, None)], key=repr)


def test_enrichment_plan_stays_linear(spark, tmp_path):
    """Month-partitioned sources must not multiply the base plan."""
    path = str(tmp_path / "src")
    spark.range(100).select((F.col("id") % 3 + 202501).cast("int").alias("month"), F.col("id").alias("party"),
                            F.rand(1).alias("x")).write.partitionBy("month").parquet(path)
    src = spark.read.parquet(path)
    base = src.filter(F.col("month") >= 202502).select("month", "party")

    def size(n):
        sources = [enrich.FeatureSource(f"s{i}", src, {"x": f"x{i}"}, "party", i % 2) for i in range(n)]
        return len(enrich.enrich(base, sources)._jdf.queryExecution().optimizedPlan().toString())

    assert size(8) < 3 * size(4)


def test_lag_snapshots(spark):
    base = spark.createDataFrame([(202601, "a", 1), (202512, "a", 2), (202601, None, 3), (202601, "b", 4)], "month int, party string, id int")
    src = spark.createDataFrame([(202601, "a", 5), (202512, "a", 7), (202511, "a", 9), (202512, "a", 8), (202601, None, 99)],
                                "month int, party string, v int")
    got = enrich.lag_snapshots(base, src, "party", "v", [0, 1, 2], "v")
    assert rows(got, "id", "v_0", "v_1", "v_2") == [(1, 5, 8, 9), (2, 8, 9, None), (3, None, None, None), (4, None, None, None)]


def test_fixed_month(spark):
    src = spark.createDataFrame([(202501, "a", 1), (202501, "a", 1), (202502, "a", 2)], "month int, k string, x int")
    got = enrich.fixed_month(src, 202501, 202502, "k", {"x": "S__x"})
    assert rows(got, "k", "S__x", "month") == [("a", 1, 202502)]


def test_mean_decrease_forms_agree(spark):
    rnd = random.Random(3)
    months = [202410, 202411, 202412, 202501]
    data = [(p, m, float(rnd.randrange(100))) for p in range(60) for m in months for _ in range(rnd.randrange(3))]
    facts = spark.createDataFrame(data, "party int, month int, x double")
    grid = densify.with_previous(densify.densify(facts, "party", months, "x"), "party", "x", "prev")
    from panelscore.functions.features import decreasing_variation
    slow = (grid.withColumn("d", decreasing_variation("x", "prev")).filter(F.col("month") > months[0])
            .groupBy("party").agg(F.avg("d").alias("d")))
    fast = densify.mean_decrease(facts, "party", months, "x", "d")
    base = facts.select("party").distinct().withColumn("month", F.lit(202502))
    lagged = densify.mean_decrease_before(base, facts, "party", "x", "d")

    def norm(df):
        return {p: None if d is None else round(d, 9) for p, d in rows(df, "party", "d")}

    assert norm(slow) == norm(fast) == norm(lagged)


# ---- relations -------------------------------------------------------------------------------


def test_owner_choice_without_self_join(spark):
    rnd = random.Random(11)
    data = {(rnd.randrange(40), rnd.randrange(40)) for _ in range(200)}
    kinds = {p: rnd.choice(["6", "1", None]) for p in range(40)}
    df = spark.createDataFrame([(p, r, kinds[p]) for p, r in data], "p int, r int, kind string")
    company = F.coalesce(F.col("kind") == "6", F.lit(False))
    chosen = relations.canonical_owner(df, "p", "r", company)
    joined = relations.flag_chosen(df, chosen, ["p", "r"]).filter("is_chosen = 1").select("p", "r").distinct()
    assert rows(relations.chosen_owner_pairs(df, "p", "r", company), "p", "r") == rows(joined, "p", "r")


# ---- arrears ---------------------------------------------------------------------------------


def test_arrears(spark):
    day = dt.date(2025, 1, 10)
    bal = spark.createDataFrame([
        ("x", day, "0001", 5, 10.0), ("x", day, "1001", 9, 10.0), ("x", dt.date(2025, 1, 11), "1001", 50, 10.0),
        ("x", day, "0001", 99, -1.0), ("x", day, "0007", 80, 10.0), ("y", day, "0001", 3, 1.0), ("z", day, "0001", 7, 1.0),
        ("x", dt.date(2024, 12, 31), "0001", 70, 1.0), ("x", day, "0001", 0, 1.0)],
        "account string, balance_day date, currency string, days_past_due int, total_debt double")
    rates = spark.createDataFrame([("1001", day, 3.5), ("0001", day, 9.9)], "currency string, balance_day date, rate double")
    acc = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "p"), ("x", "p")], "account string, party string")
    priced = arrears.with_local_debt(arrears.overdue_days(bal, 202501, 202501), rates)
    assert priced.count() == 7
    assert rows(arrears.customer_month_arrears(priced, acc), "month", "party", "max_days_past_due") == [(202501, "p", 9), (202501, "q", 9)]
    staged = arrears.account_day(priced, acc)
    assert staged.count() == 11
    direct = staged.filter("debt_local > 0").groupBy("month", "party").agg(F.max("days_past_due"))
    assert rows(direct) == [(202501, "p", 9), (202501, "q", 9)]


# ---- ranks, profile, drift -------------------------------------------------------------------


@pytest.fixture(scope="module")
def values(spark):
    rnd = np.random.default_rng(8)
    n = 6000
    a = np.where(np.arange(n) % 3 == 0, 5.0, rnd.normal(5, 3, n))
    b = rnd.integers(0, 4, n).astype(float)
    side = rnd.integers(0, 2, n)
    data = [(None if i % 11 == 0 else float(a[i]), float(b[i]), int(side[i]), None) for i in range(n)]
    return spark.createDataFrame(data, "a double, b double, side int, nothing double")


def test_exact_quantiles(values):
    counts = ranks.value_counts(ranks.melt(values, ["a", "b"]), {"n": F.lit(1)})
    got = {r["variable"]: r for r in ranks.exact_quantiles(counts, {"q1": 0.013, "q5": 0.5, "q9": 0.999}).collect()}
    for c in ("a", "b"):
        x = np.array([r[0] for r in values.select(c).dropna().collect()])
        assert [got[c][q] for q in ("q1", "q5", "q9")] == pytest.approx(list(np.quantile(x, [0.013, 0.5, 0.999])), abs=1e-9)
        assert got[c]["n_distinct"] == len(set(x))


def test_images_are_the_bits_in_order(spark):
    rnd = np.random.default_rng(3)
    x = [0.0, 5e-324, 1e-310, 2.0 ** -1022, np.nextafter(2.0 ** -1022, 0), 1e-300, 0.1, np.nextafter(0.1, 1), 1.7e308,
         np.finfo(float).max, float("inf"), *[2.0 ** k for k in range(-1074, 1024, 7)],
         *[np.nextafter(2.0 ** k, 0) for k in range(-1021, 1024, 5)], *np.exp(rnd.normal(0, 200, 500))]
    x = [float(v) for v in x] + [-float(v) for v in x if v]
    made = ranks.with_image(spark.createDataFrame([(v,) for v in x], "value double")).collect()
    for r in made:
        assert r["image"] == int(np.float64(abs(r["value"])).view(np.int64)) * (-1 if r["value"] < 0 else 1)
    none = ranks.with_image(spark.createDataFrame([(None,), (float("nan"),)], "value double")).collect()
    assert [r["image"] for r in none] == [None, None]


@pytest.mark.parametrize("most", [1, 7, 40])
def test_ranges_are_split_until_they_are_small(spark, most):
    """Values of a narrow range, as timestamps are: no window is larger than the bound, and the counts are exact."""
    base = 1.7e9
    data = [(s, "v", base + i * 0.25, 1 + i % 3) for s in ("x", None) for i in range(300)]
    data += [("x", "v", -1e300, 2), ("x", "v", 0.0, 1), ("x", "w", 5.0, 4)]
    bits = np.array([3.0]).view(np.int64)[0]  # neighbours differ in the last bit
    data += [("x", "u", float(np.array([bits + i]).view(float)[0]), 1) for i in range(12)]
    counts = spark.createDataFrame(data, "segment string, variable string, value double, n long")
    ranges = ranks.value_ranges(ranks.with_image(counts), ["n"], ["segment"], most)
    assert len(ranges) > 1
    for shift, leaves in ranges:
        assert all(r["n_values"] <= most or shift == 0 for r in leaves.collect())
    got = {(r["segment"], r["variable"], r["value"]): (r["cum_n"], r["total_n"])
           for r in ranks.cumulative_counts(counts, ["n"], ["segment"], most).collect()}
    assert len(got) == len(data)
    for s, v in (("x", "v"), (None, "v"), ("x", "w"), ("x", "u")):
        mine = sorted((x, n) for a, b, x, n in data if (a, b) == (s, v))
        total, run = sum(n for _, n in mine), 0
        for x, n in mine:
            run += n
            assert got[s, v, x] == (run, total)


def test_drift_reads_each_side_once(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_shipdate", "l_quantity", "l_tax")
    split = F.lit("1998-01-01").cast("date")
    counts, nulls = drift.side_counts(rows.where(F.col("l_shipdate") < split), rows.where(F.col("l_shipdate") >= split),
                                      ["l_quantity", "l_tax"])
    for made in (counts, nulls):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert "lineitem" not in plan and plan.count("Relation [") == 1
    assert drift.statistics(rows.limit(0), rows, ["l_tax"]).count() <= 1


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame([(float(i % 10),) for i in range(50)] + [(float("nan"),)] * 5, "x double")
    got = profile.variable_profile(df, ["x"]).first()
    assert (got["n"], got["max"], got["mean"], got["p75"], got["n_distinct"]) == (50, 9.0, 4.5, 7.0, 10)
    bins = profile.histogram(df, ["x"], 5).collect()
    assert sorted((r["bin"], r["n"]) for r in bins) == [(i, 10) for i in range(1, 6)]
    assert drift.drift(df, df, ["x"]).first()["psi"] == 0


def test_profile(values):
    got = {r["variable"]: r for r in profile.variable_profile(values, ["a", "b", "nothing"]).collect()}
    assert got["nothing"]["n"] == 0 and got["nothing"]["null_light"] == "red" and got["nothing"]["n_distinct"] == 0
    x = np.array([r[0] for r in values.select("a").dropna().collect()])
    assert got["a"]["std"] == pytest.approx(x.std(ddof=1)) and got["a"]["p50"] == pytest.approx(np.median(x))
    approx = {r["variable"]: r for r in profile.variable_profile(values, ["a", "b"], exact=False).collect()}
    assert approx["b"]["n_distinct"] == 4 and approx["a"]["n"] == got["a"]["n"]


def test_drift_against_brute_force(values):
    base, cur = values.filter("side = 0"), values.filter("side = 1").withColumn("a", F.col("a") + 0.4)
    got = {r["variable"]: r for r in drift.drift(base, cur, ["a", "b"]).collect()}
    for c in ("a", "b"):
        x = [r[0] for r in base.select(c).collect()]
        y = [r[0] for r in cur.select(c).collect()]
        xs, ys = np.array([v for v in x if v is not None]), np.array([v for v in y if v is not None])
        edges = sorted(set(np.quantile(xs, np.arange(1, 10) / 10)))
        pb = [np.sum(np.searchsorted(edges, xs, side="left") == i) for i in range(len(edges) + 1)] + [len(x) - len(xs)]
        pc = [np.sum(np.searchsorted(edges, ys, side="left") == i) for i in range(len(edges) + 1)] + [len(y) - len(ys)]
        p, q = (np.maximum(np.array(v) / s, 1e-6) for v, s in ((pb, len(x)), (pc, len(y))))
        keep = [(a, b) for a, b, i, j in zip(p, q, pb, pc) if i or j]
        assert got[c]["psi"] == pytest.approx(sum((b - a) * np.log(b / a) for a, b in keep), abs=1e-9)
        grid = np.unique(np.concatenate([xs, ys]))
        d = np.max(np.abs(np.searchsorted(np.sort(xs), grid, "right") / len(xs) - np.searchsorted(np.sort(ys), grid, "right") / len(ys)))
        assert got[c]["ks"] == pytest.approx(d, abs=1e-12)
    assert got["a"]["ks_p"] < 0.05 and got["a"]["ks_light"] == "red" and got["b"]["ks_p"] > 0.05


def test_null_keys_are_not_compared(spark):
    a = spark.createDataFrame([(1, 1.0), (None, 2.0), (None, 2.0)], "k int, v double")
    got = compare.compare_rows(a, a, ["k"], ["v"]).collect()
    assert len(got) == 3 and sum(r["n_base"] == r["n_target"] == 1 for r in got) == 1


def test_no_drift_against_itself(values):
    got = drift.drift(values, values, ["a", "b"]).collect()
    assert all(r["psi"] == 0 and r["ks"] == 0 and r["ks_p"] == 1 and r["summary"] == "green" for r in got)


def test_histogram(spark):
    df = spark.createDataFrame([(float(v), 3.0) for v in range(11)] + [(None, 3.0)], "x double, same double")
    got = rows(profile.histogram(df, ["x", "same"], bins=5), "variable", "bin", "n")
    assert got == [("same", 1, 12)] + [("x", b, 2 if b < 5 else 3) for b in range(1, 6)]


def test_buckets_sum_to_100(spark):
    df = spark.createDataFrame([(202501, None), (202501, 0.02), (202501, 0.5), (202502, 0.0)], "month int, pd double")
    got = profile.buckets_by_month(df, "pd")
    assert got.count() == 14
    assert rows(got.groupBy("month").agg(F.sum("pct"))) == [(202501, pytest.approx(100.0)), (202502, pytest.approx(100.0))]


def test_key_check(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert tuple(profile.key_check(df, "k").first()) == (2, 3, 2, 1)
    assert tuple(profile.key_check(df, "k", exact=False).first()) == (2, 3, 2, 1)


def test_evolution_lights(spark):
    hist = spark.createDataFrame([(202501, 1.0), (202502, 3.0)], "month int, x double")
    evo = profile.evolution(hist, ["x"])
    assert rows(profile.evolution_pivot(evo, "mean", [202501, 202502, 202503])) == [("x", 1.0, 3.0, None)]
    cur = profile.moments(spark.createDataFrame([(2.2,)], "x double"), ["x"])
    r = profile.evolution_lights(cur, profile.historical_averages(evo)).first()
    assert r["average"] == 2.0 and r["deviation"] == pytest.approx(0.1) and r["light"] == "yellow"
    assert tuple(profile.light_counts(profile.evolution_lights(cur, profile.historical_averages(evo)), "light").first()) == (0, 1, 0)


# ---- compare, certify, trace -----------------------------------------------------------------


def test_compare_cases(spark):
    schema = "k int, x double, s string, t double"
    base = spark.createDataFrame([(1, 1.0, "a", 1.0), (2, 1.0, "a", 1.0), (3, None, None, 1.0), (4, None, "a", 1.0), (5, 1.0, "a", 1.0), (7, float("nan"), "a", 1.0)], schema)
    target = spark.createDataFrame([(1, 1.0000001, "a", "1"), (2, 1.1, "b", "1"), (3, None, None, "1"), (4, 2.0, "a", "1"), (6, None, "a", "1"), (7, float("nan"), "a", "1")],
                                   "k int, x double, s string, t string")
    _, summary, skipped = compare.compare_tables(base, target, ["k"], ["x", "s", "t"])
    assert skipped == [("t", "number vs text")]
    assert rows(summary, "variable", "count_0", "count_1", "passed") == [("s", 3, 4, 0), ("x", 4, 3, 0)]
    assert tuple(compare.key_overlap(compare.paired(base, target, ["k"], [])).first()) == (5, 1, 1, 0)
    common = compare.compare_common(base, target, ["k"])
    assert rows(common, "variable", "count_1") == [("s", 4), ("x", 2)]
    with pytest.raises(ValueError):
        compare.compare_tables(base, target.limit(2), ["k"], ["x"])


def test_repeated_keys_cost_one_row(spark):
    base = spark.createDataFrame([(1, 1.0)] * 500 + [(2, 1.0)], "k int, x double")
    got = compare.compare_rows(base, base, ["k"], ["x"])
    assert got.count() == 2 and compare.key_overlap(got).first()["n_repeated"] == 1
    assert rows(got, "k", "x_eq") == [(1, 0), (2, 1)]


def test_schema_rows(spark):
    a = spark.createDataFrame([], "k int, x double, only_a string").schema
    b = spark.createDataFrame([], "k bigint, x double, only_b string").schema
    assert rows(compare.compare_schemas(a, b, spark)) == [("k", "type", "int", "bigint"), ("only_a", "only_base", "string", None),
                                                          ("only_b", "only_target", None, "string")]
    assert compare.column_changes(["a", "b"], ["b", "c"]) == {"common": ["b"], "added": ["c"], "removed": ["a"]}


def test_certification(spark):
    good = spark.createDataFrame([(i, float(i), "s" if i % 2 else "t") for i in range(200)], "k int, x double, seg string")
    bad = good.withColumn("x", F.when(F.col("seg") == "t", F.col("x") + 1).otherwise(F.col("x")))
    report = certify.certify_segments(good, bad, ["k"], ["x"], "seg", critical=["x"])
    status = dict(rows(certify.overall(report), "segment", "status"))
    assert status == {"global": "rejected", "s": "certified", "t": "rejected"}
    certify.gate(certify.certify(good, good, ["k"], ["x"], critical=["x"]))
    with pytest.raises(ValueError):
        certify.gate(report)
    fewer = dict(rows(certify.certify(good.filter("k < 150"), good, ["k"], ["x"]), "check", "light"))
    assert fewer["records"] == "red" and fewer["schema"] == "green"


def test_lag_trace(spark):
    src = spark.createDataFrame([(202501, i, float(i)) for i in range(10)] + [(202502, i, float(i) if i == 0 else i + 100.0) for i in range(10)],
                                "month int, k int, v double")
    tgt = spark.createDataFrame([(202502, i, float(i) if i < 6 else (i + 100.0 if i < 9 else -1.0)) for i in range(10)], "month int, k int, t double")
    assert rows(trace.lag_trace(src, tgt, "k", "v", "t", 202501, 202502), "verdict", "n") == [("none", 1), ("previous", 5), ("process", 3)]


def test_lag_evidence(spark):
    src = [(202500 + m, k, float(k if k == 0 else k + 100 * m), 5.0, None if m == 2 and k == 1 else float(k * m)) for m in (1, 2, 3) for k in range(8)]
    tgt = [(202503, k, float(k + 200), 5.0, float(k * (2 + k % 2))) for k in range(8)]
    source = spark.createDataFrame(src, "month int, k int, a double, b double, c double")
    target = spark.createDataFrame(tgt, "month int, k int, ta double, tb double, tc double")
    got = trace.lag_evidence(source, target, "k", {"a": ("a", "ta"), "b": ("b", "tb"), "c": ("c", "tc")},
                             [202501, 202502, 202503], 202503)
    assert rows(got, "variable", "candidate", "voters", "votes", "verdict") == [
        ("a", 202501, 7, 0, "202502"), ("a", 202502, 7, 7, "202502"), ("a", 202503, 7, 0, "202502"),
        ("b", 202501, 0, 0, "ambiguous"), ("b", 202502, 0, 0, "ambiguous"), ("b", 202503, 0, 0, "ambiguous"),
        ("c", 202501, 6, 0, "ambiguous"), ("c", 202502, 6, 3, "ambiguous"), ("c", 202503, 6, 3, "ambiguous")]
    none = trace.lag_evidence(source, target.withColumn("ta", F.lit(-1.0)), "k", {"a": ("a", "ta")}, [202501, 202502], 202503)
    assert {r["verdict"] for r in none.collect()} == {"none"}
    empty = trace.lag_evidence(source.limit(0), target, "k", {"a": ("a", "ta")}, [202501], 202503)
    assert rows(empty, "voters", "share", "verdict") == [(0, None, "ambiguous")]


def test_segments_are_paired_once(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    copy = orders.where("o_orderkey % 17 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + (F.col("o_orderkey") % 3) / 10)
    report = certify.certify_segments(orders, copy, ["o_orderkey"], ["o_totalprice"], "o_orderpriority", critical=["o_totalprice"])
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 2 and plan.count("ReusedExchange") >= 1
    apart = certify.certify(orders, copy, ["o_orderkey"], ["o_totalprice"], critical=["o_totalprice"])
    assert rows(report.where("segment = 'global'"), "check", "value", "light") == rows(apart, "check", "value", "light")


def test_segment_pairs_with_repeated_and_missing_keys(spark):
    base = spark.createDataFrame([(1, "s", 1.0), (1, "t", 2.0), (2, "s", 3.0), (None, "s", 4.0), (3, None, 5.0), (4, "t", 6.0)],
                                 "k int, seg string, x double")
    target = spark.createDataFrame([(1, "s", 1.0), (2, "t", 3.0), (None, "s", 4.0), (3, None, 5.0), (4, "t", 6.0), (4, "t", 6.0)],
                                   "k int, seg string, x double")
    whole, within = compare.paired_by_segment(base, target, ["k"], "seg", ["x"])
    names = ("n_base", "n_target", "x_base", "x_target")
    assert rows(whole, "k", *names) == rows(compare.paired(base, target, ["k"], ["x"]), "k", *names)
    assert rows(within, "k", "seg", *names) == rows(compare.paired(base, target, ["k", "seg"], ["x"]), "k", "seg", *names)


def test_equal_blocks_carry_no_rows(spark):
    base = spark.range(20_000).select((F.col("id") % 4 + 202501).cast("int").alias("month"), "id", (F.col("id") * 0.5).alias("x"))
    target = base.withColumn("x", F.when(F.col("id").isin(5, 4001), F.col("x") + 1).otherwise(F.col("x"))).where("id <> 77")
    a, b, report = compare.differing_parts(base, target, ["id"], ["x"], "month", 16, 16)
    assert report.count() == 64 and report.where("not same").count() <= 3
    assert a.count() < 150 and b.count() == a.count() - 1
    found = compare.compare_rows(a, b, ["id"], ["x"])
    assert rows(found.where("x_eq = 0 or n_target = 0"), "id") == [(4001,), (5,), (77,)]
    a, b, report = compare.differing_parts(base, base, ["id"], ["x"], "month", 16, 16)
    assert a.count() == 0 and b.count() == 0 and report.where("not same").count() == 0
    twice = base.unionByName(base.where("id = 9"))
    a, b, _ = compare.differing_parts(base, twice, ["id"], ["x"], None, 16, 16)
    assert b.where("id = 9").count() == 2


# ---- models ----------------------------------------------------------------------------------


def test_models(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0)], "k int, a double, b double")
    model = spark.createDataFrame([("(intercept)", 0.5), ("a", 1.0), ("b", -1.0)], "feature string, coefficient double")
    got = dict(rows(models.score_linear(df, model), "k", "pd_raw"))
    assert got[1] == pytest.approx(1 / (1 + np.exp(0.5))) and got[2] is None
    with pytest.raises(ValueError):
        models.score_linear(df, {"missing": 1.0})
    with pytest.raises(ValueError):
        models.read_coefficients(model.unionByName(model))
    empty = models.score_vectorised(df.filter("k > 5"), ["a"], lambda b: b["a"].to_numpy())
    assert empty.count() == 0
    seg = models.score_segments(df, [(1, "k = 1", {"b": 0.0}), (2, "k = 2", {"b": 1.0})])
    assert rows(seg, "k", "segment_id") == [(1, 1), (2, 2)]
    parts = models.score_segment_tables(df, [(1, "k = 1"), (2, "k >= 1")], lambda i, d: d.withColumn("p", F.lit(i)))
    assert rows(parts, "k", "segment_id", "p") == [(1, 1, 1), (1, 2, 2), (2, 2, 2)]


def test_routed_models(spark):
    data = [(i, "s" if i % 3 == 0 else None if i % 3 == 1 else "t", float(i), float(-i)) for i in range(30)]
    df = spark.createDataFrame(data, "k int, seg string, a double, b double").repartition(3)
    by_segment = [(7, "seg = 's'", ["a"], lambda x: x["a"] * 2), (3, "a >= 15", ["b", "a"], lambda x: x["b"] + x["a"] / 2)]
    first = dict((r["k"], (r["segment_id"], r["pd_raw"])) for r in models.score_routed(df, by_segment).collect())
    assert first == {i: (7, i * 2.0) if i % 3 == 0 else (3, -i / 2) for i in range(30) if i % 3 == 0 or i >= 15}
    every = models.score_routed(df, by_segment, "all")
    assert sorted(rows(every, "k", "segment_id")) == sorted([(i, 7) for i in range(0, 30, 3)] + [(i, 3) for i in range(15, 30)])
    assert models.score_routed(df.limit(0), by_segment).count() == 0
    with pytest.raises(ValueError):
        models.score_routed(df, [*by_segment, by_segment[0]])


def test_sketch_state_by_month(spark, tmp_path):
    rnd = np.random.default_rng(2)
    data = [(202501 + i % 3, "s" if i % 4 else None, None if i % 10 == 0 else float(rnd.normal(1e6, 1)), float(i % 50)) for i in range(3000)]
    df = spark.createDataFrame(data, "month int, seg string, x double, y double")
    path = str(tmp_path / "state")
    sketches.update_state(df, path, ["x", "y"], [202501, 202502], by=["seg"])
    before = {(r["month"], r["seg"], r["variable"]): r for r in sketches.read_state(spark, path).collect()}
    sketches.update_state(df, path, ["x", "y"], [202502], by=["seg"])
    again = {(r["month"], r["seg"], r["variable"]): r for r in sketches.read_state(spark, path).collect()}
    assert before.keys() == again.keys() and {k[0] for k in again} == {202501, 202502}
    assert all(before[k][c] == again[k][c] for k in again for c in ("n_rows", "n", "n_zero", "mean", "m2", "min", "max"))
    sketches.update_state(df, path, ["x", "y"], [202503], by=["seg"])
    whole = {(r["seg"], r["variable"]): r for r in sketches.merged_profile(sketches.read_state(spark, path), {"p50": 0.5}, ["seg"]).collect()}
    for seg in ("s", None):
        for at, name in ((2, "x"), (3, "y")):
            v = np.array([r[at] for r in data if r[1] == seg and r[at] is not None])
            got = whole[seg, name]
            assert got["n"] == len(v) and got["min"] == v.min() and got["max"] == v.max()
            assert got["mean"] == pytest.approx(v.mean(), rel=1e-12) and got["std"] == pytest.approx(v.std(ddof=1), rel=1e-9)
            assert abs(got["n_distinct"] - len(set(v))) <= 0.06 * len(set(v)) + 1
            assert abs((v <= got["p50"]).mean() - 0.5) < 0.05 or (v < got["p50"]).mean() <= 0.5 <= (v <= got["p50"]).mean()


def test_rows_without_key_are_spread_in_every_join(spark):
    left = spark.range(2000).select(F.when(F.col("id") < 500, F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(400, 1400).select(F.when(F.col("id") < 700, F.col("id")).alias("k"), F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        full = joins.with_side_flags(left, right, ["k"])
        assert full.count() == 2000 + 1000 - 100
        assert full.where("in_left = 1 and in_right = 1").count() == 100
        part = enrich.membership(left, right, ["k"])
        assert part.count() == 2000 and part.where("is_member = 1").count() == 100
        back = enrich.attach_generated(left, right.where("k is not null"), ["k"], ["w"])
        assert back.count() == 2000 and back.where("w is not null").count() == 100
        for df in (full, part, back):
            sizes = [r["count"] for r in df.where("k is null").groupBy(F.spark_partition_id()).count().collect()]
            assert len(sizes) > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

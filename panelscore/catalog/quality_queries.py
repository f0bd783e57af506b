"""Key checks, profiles, evolution, histograms, score buckets and drift on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscore.catalog.mapping import CUSTOMER_PD_SQL, PORTFOLIO_SQL, customer_pd, portfolio, table
from panelscore.catalog.registry import query
from panelscore.functions import months as months_mod
from panelscore.functions.months import first_day, in_months, month_key, month_list
from panelscore.functions.scoring import PD_CUTS, bucket_labels
from panelscore.operators import drift, profile, rollup, sketches
from panelscore.plans import quality
from panelscore.session import new_folder, staged
from panelscore.sources import sinks

COLUMNS = ["quantity", "price", "discount", "tax"]

_LINES_SQL = """
lines AS (
  SELECT (year(l_shipdate) * 100 + month(l_shipdate))::int AS month, l_quantity AS quantity, l_extendedprice AS price,
         CASE WHEN l_discount <> 0.03 THEN l_discount END AS discount,
         CASE WHEN l_returnflag <> 'R' THEN l_tax END AS tax
  FROM lineitem)"""


def _lines(spark, sf_dir, where=None):
    """``where`` is a predicate on the raw ship date, so that it reaches the scan."""
    li = table(spark, sf_dir, "lineitem")
    return (li if where is None else li.filter(where)).select(
        month_key("l_shipdate").alias("month"), F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_discount") != 0.03, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("tax"))


#: The month in which current values are judged is the last one observed.
_LAST = "(SELECT max(year(l_shipdate) * 100 + month(l_shipdate)) FROM lineitem)"


def _last_month(spark, sf_dir) -> int:
    """From the largest raw date, which the file statistics have."""
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("d")).select(month_key("d")).first()[0]


def _each(select: str) -> str:
    return "\nUNION ALL ".join(select.replace("{c}", c) for c in COLUMNS)


@query("key_check", f"""
WITH {PORTFOLIO_SQL}, k AS (SELECT CASE WHEN status <> 'P' THEN party END AS party FROM portfolio)
SELECT count_if(party IS NULL)::bigint AS null_keys, count(party)::bigint AS n_keys,
       count(DISTINCT party)::bigint AS n_distinct, (count(party) - count(DISTINCT party))::bigint AS n_duplicates
FROM k
""")
def key_check(spark, sf_dir):
    p = portfolio(spark, sf_dir).select(F.when(F.col("status") != "P", F.col("party")).alias("party"))
    return profile.key_check(p, "party")


@query("key_check_approx")
def key_check_approx(spark, sf_dir):
    return profile.key_check(portfolio(spark, sf_dir), "account", exact=False)


@query("duplicate_keys", f"""
WITH {PORTFOLIO_SQL}
SELECT party, month, count(*)::bigint AS n_rows FROM portfolio GROUP BY party, month HAVING count(*) > 1
""")
def duplicate_keys(spark, sf_dir):
    return rollup.duplicate_keys(portfolio(spark, sf_dir), ["party", "month"])


@query("variable_profile", f"""
WITH {_LINES_SQL}, p AS ({_each('''
SELECT '{c}' AS variable, count({c})::bigint AS n, round(100.0 * count_if({c} IS NULL) / count(*), 6)::double AS null_pct,
  round(100.0 * count_if({c} = 0) / count(*), 6)::double AS zero_pct, count(DISTINCT {c})::bigint AS n_distinct,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max,
  round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75 FROM lines''')})
SELECT *, CASE WHEN null_pct >= 20 THEN 'red' WHEN null_pct >= 5 THEN 'yellow' ELSE 'green' END AS null_light FROM p
""")
def variable_profile(spark, sf_dir):
    out = profile.variable_profile(_lines(spark, sf_dir), COLUMNS)
    return out.withColumns({c: F.round(c, 6) for c in ("null_pct", "zero_pct", "mean", "std", "p25", "p50", "p75")})


@query("variable_profile_approx")
def variable_profile_approx(spark, sf_dir):
    return profile.variable_profile(_lines(spark, sf_dir), COLUMNS, exact=False)


_EVOLUTION_SQL = f"""{_LINES_SQL},
evo AS ({_each('''
SELECT '{c}' AS variable, month, count({c})::bigint AS n, 100.0::double * count_if({c} IS NULL) / count(*) AS null_pct,
  avg({c}) AS mean, stddev_samp({c}) AS std FROM lines GROUP BY month''')})"""


@query("evolution", f"""
WITH {_EVOLUTION_SQL}
SELECT variable, month, n, round(null_pct, 6) AS null_pct, round(mean, 6) AS mean, round(std, 6) AS std FROM evo
""")
def evolution(spark, sf_dir):
    out = profile.evolution(_lines(spark, sf_dir), COLUMNS)
    return out.select("variable", "month", "n", *[F.round(c, 6).alias(c) for c in ("null_pct", "mean", "std")])


_PIVOT_MONTHS = month_list(199201, 200312)  # all months that items can be shipped in


@query("evolution_pivot", f"""
WITH {_EVOLUTION_SQL}
SELECT variable, {', '.join(f'round(max(CASE WHEN month = {m} THEN mean END), 6) AS m_{m}' for m in _PIVOT_MONTHS)}
FROM evo GROUP BY variable
""")
def evolution_pivot(spark, sf_dir):
    evo = profile.evolution(_lines(spark, sf_dir), COLUMNS)
    out = profile.evolution_pivot(evo, "mean", _PIVOT_MONTHS)
    return out.select("variable", *[F.round(f"m_{m}", 6).alias(f"m_{m}") for m in _PIVOT_MONTHS])


@query("evolution_lights", f"""
WITH {_EVOLUTION_SQL},
h AS (SELECT variable, avg(mean) AS average FROM evo WHERE month < {_LAST} GROUP BY variable),
d AS (SELECT c.variable, c.mean AS current, h.average, CASE WHEN h.average <> 0 THEN abs(c.mean - h.average) / abs(h.average) END AS deviation
      FROM evo c LEFT JOIN h USING (variable) WHERE c.month = {_LAST})
SELECT variable, round(current, 6) AS current, round(average, 6) AS average, round(deviation, 6) AS deviation,
  CASE WHEN deviation IS NULL THEN 'yellow' WHEN deviation >= 0.25 THEN 'red' WHEN deviation >= 0.05 THEN 'yellow' ELSE 'green' END AS light
FROM d
""")
def evolution_lights(spark, sf_dir):
    last = _last_month(spark, sf_dir)
    history = _lines(spark, sf_dir, F.col("l_shipdate") < F.lit(first_day(last)))
    averages = profile.historical_averages(profile.evolution(history, COLUMNS))
    current = profile.moments(_lines(spark, sf_dir, in_months("l_shipdate", last, last)), COLUMNS)
    out = profile.evolution_lights(current, averages)
    return out.withColumns({c: F.round(c, 6) for c in ("current", "average", "deviation")})


@query("histogram", f"""
WITH {_LINES_SQL}, b AS ({_each('''
SELECT '{c}' AS variable, x AS value, lo, hi FROM (SELECT {c} AS x, (SELECT min({c}) FROM lines) AS lo,
  (SELECT max({c}) FROM lines) AS hi FROM lines) WHERE x IS NOT NULL''')}),
n AS (SELECT variable, lo, hi, least(floor((value - lo) / ((hi - lo) / 30.0::double))::int + 1, 30) AS bin FROM b)
SELECT variable, bin::int AS bin, round(lo + (bin - 1) * ((hi - lo) / 30.0::double), 6) AS lower,
       round(lo + bin * ((hi - lo) / 30.0::double), 6) AS upper, count(*)::bigint AS n
FROM n GROUP BY variable, lo, hi, bin
""")
def histogram(spark, sf_dir):
    out = profile.histogram(_lines(spark, sf_dir), COLUMNS)
    return out.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("histogram_nan", """
WITH v AS (SELECT c_acctbal AS x FROM customer WHERE c_custkey % 30 <> 0),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT 'x' AS variable, least(floor((x - lo) / ((hi - lo) / 30.0::double))::int + 1, 30)::int AS bin, count(*)::bigint AS n
FROM v, e GROUP BY ALL
""")
def histogram_nan(spark, sf_dir):
    """Values that are no numbers count as missing."""
    x = F.when(F.col("c_custkey") % 30 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return profile.histogram(table(spark, sf_dir, "customer").select(x.alias("x")), ["x"]).select("variable", "bin", "n")


_LABELS = bucket_labels()
_BUCKET_CASE = "CASE WHEN pd IS NULL THEN 'C0: NULL' WHEN pd < 0 THEN 'C?' " + " ".join(
    f"WHEN pd < {cut} THEN '{lab}'" for cut, lab in zip(PD_CUTS, _LABELS[1:])) + f" ELSE '{_LABELS[-1]}' END"


@query("pd_buckets_by_month", f"""
WITH {PORTFOLIO_SQL}, {CUSTOMER_PD_SQL},
s AS (SELECT DISTINCT p.month, p.party FROM portfolio p),
v AS (SELECT s.month, {_BUCKET_CASE} AS bucket FROM s JOIN customer_pd c USING (party)),
totals AS (SELECT month, count(*) AS total FROM v GROUP BY month),
labels AS (SELECT unnest([{', '.join(f"'{lab}'" for lab in _LABELS)}]) AS bucket),
n AS (SELECT month, bucket, count(*) AS n FROM v GROUP BY month, bucket)
SELECT t.month, l.bucket, coalesce(n.n, 0)::bigint AS n, t.total::bigint AS total,
       round(100.0::double * coalesce(n.n, 0) / t.total, 4) AS pct
FROM totals t CROSS JOIN labels l LEFT JOIN n ON n.month = t.month AND n.bucket = l.bucket
""")
def pd_buckets_by_month(spark, sf_dir):
    panel = portfolio(spark, sf_dir).select("month", "party").distinct()
    scored = panel.join(customer_pd(spark, sf_dir).select("party", "pd"), "party")
    out = profile.buckets_by_month(scored, "pd")
    return out.withColumn("pct", F.round("pct", 4))


# ---- drift ---------------------------------------------------------------------------------

SPLIT = 199801

_PSI_SQL = """
SELECT '{c}' AS variable, sum((pc - pb) * ln(pc / pb)) AS psi FROM (
  SELECT greatest(b / sum(b) OVER (), 1e-6) AS pb, greatest(c / sum(c) OVER (), 1e-6) AS pc FROM (
    SELECT bin, count_if(month < {split})::double AS b, count_if(month >= {split})::double AS c FROM (
      SELECT month, CASE WHEN {c} IS NULL THEN -1 ELSE len(list_filter(
        (SELECT list_distinct(quantile_cont({c}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) FROM lines WHERE month < {split}),
        lambda e: {c} > e)) END AS bin FROM lines) GROUP BY bin))""".replace("{split}", str(SPLIT))

_KS_SQL = """
SELECT '{c}' AS variable, max(abs(cb / nb - cc / nc)) AS ks, max(nb) AS nb, max(nc) AS nc FROM (
  SELECT sum(b) OVER (ORDER BY v) AS cb, sum(c) OVER (ORDER BY v) AS cc, sum(b) OVER () AS nb, sum(c) OVER () AS nc FROM (
    SELECT {c} AS v, count_if(month < {split})::double AS b, count_if(month >= {split})::double AS c
    FROM lines WHERE {c} IS NOT NULL GROUP BY v))""".replace("{split}", str(SPLIT))


def _sides(spark, sf_dir):
    split = F.lit(first_day(SPLIT))
    return (_lines(spark, sf_dir, F.col("l_shipdate") < split), _lines(spark, sf_dir, F.col("l_shipdate") >= split))


@query("drift_psi", f"""
WITH {_LINES_SQL}, p AS ({_each(_PSI_SQL)})
SELECT variable, round(psi, 8) AS psi,
       CASE WHEN psi >= 0.25 THEN 'red' WHEN psi >= 0.1 THEN 'yellow' ELSE 'green' END AS psi_light FROM p
""")
def drift_psi(spark, sf_dir):
    base, current = _sides(spark, sf_dir)
    out = drift.statistics(base, current, COLUMNS)
    return out.select("variable", F.round("psi", 8).alias("psi"),
                      profile.light("psi", *drift.PSI_LIGHT).alias("psi_light"))


_P_SQL = ("CASE WHEN lam < 0.2 THEN 1.0::double ELSE greatest(0.0::double, least(1.0::double, list_sum(list_transform("
          "range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 2.0::double ELSE -2.0::double END) "
          "* exp(-2.0::double * k * k * lam * lam))))) END")


@query("drift_ks", f"""
WITH {_LINES_SQL}, d AS ({_each(_KS_SQL)}),
l AS (SELECT variable, ks, (sqrt(nb * nc / (nb + nc)) + 0.12::double + 0.11::double / sqrt(nb * nc / (nb + nc))) * ks AS lam FROM d)
SELECT variable, round(ks, 8) AS ks, round({_P_SQL}, 6) AS ks_p FROM l
""")
def drift_ks(spark, sf_dir):
    base, current = _sides(spark, sf_dir)
    return drift.statistics(base, current, COLUMNS).select("variable", F.round("ks", 8).alias("ks"), F.round("ks_p", 6).alias("ks_p"))


@query("drift_kpis", f"""
WITH {_LINES_SQL}, p AS ({_each(_PSI_SQL)}), d AS ({_each(_KS_SQL)}),
l AS (SELECT variable, (sqrt(nb * nc / (nb + nc)) + 0.12::double + 0.11::double / sqrt(nb * nc / (nb + nc))) * ks AS lam FROM d),
s AS (SELECT variable, psi, {_P_SQL} AS ks_p FROM p JOIN l USING (variable))
SELECT count_if(psi < 0.1)::bigint AS green, count_if(psi >= 0.1 AND psi < 0.25)::bigint AS yellow,
       count_if(psi >= 0.25)::bigint AS red, count_if(ks_p < 0.05)::bigint AS n_significant,
       round(avg(psi), 8) AS avg_psi, round(max(psi), 8) AS max_psi FROM s
""")
def drift_kpis(spark, sf_dir):
    base, current = _sides(spark, sf_dir)
    out = drift.drift_kpis(drift.drift(base, current, COLUMNS))
    return out.withColumns({"avg_psi": F.round("avg_psi", 8), "max_psi": F.round("max_psi", 8)})


_SEGMENT_SQL = """
seg AS (SELECT CASE WHEN l_linestatus = 'F' THEN 'F' END AS segment, l_orderkey AS id,
               (year(l_shipdate) * 100 + month(l_shipdate))::int AS month, l_quantity AS quantity,
               CASE WHEN l_discount <> 0.03 THEN l_discount END AS discount, l_tax * 3.0::double AS pd FROM lineitem)"""


def _segments(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.when(F.col("l_linestatus") == "F", F.lit("F")).alias("segment"), F.col("l_orderkey").alias("id"),
                     month_key("l_shipdate").alias("month"), F.col("l_quantity").alias("quantity"),
                     F.when(F.col("l_discount") != 0.03, F.col("l_discount")).alias("discount"),
                     (F.col("l_tax") * 3.0).alias("pd"))


def _job(spark, sf_dir) -> quality.Metrics:
    return quality.run(_segments(spark, sf_dir), _last_month(spark, sf_dir), ["quantity", "discount"], "id", {"pd": PD_CUTS},
                       by=["segment"])


@query("quality_by_segment", f"""
WITH {_SEGMENT_SQL}, now AS (SELECT * FROM seg WHERE month = {_LAST}),
long AS (SELECT segment, 'quantity' AS variable, quantity AS x FROM now UNION ALL SELECT segment, 'discount', discount FROM now)
SELECT segment, variable, count(x)::bigint AS n, round(100.0::double * count_if(x IS NULL) / count(*), 6) AS null_pct,
       round(avg(x), 6) AS mean, count(DISTINCT x)::bigint AS n_distinct, round(quantile_cont(x, 0.5), 6) AS p50,
       CASE WHEN 100.0::double * count_if(x IS NULL) / count(*) >= 20 THEN 'red'
            WHEN 100.0::double * count_if(x IS NULL) / count(*) >= 5 THEN 'yellow' ELSE 'green' END AS null_pct_light
FROM long GROUP BY segment, variable
""")
def quality_by_segment(spark, sf_dir):
    """The quality job by segment, of which one is null: its profile with a light per metric."""
    return _job(spark, sf_dir).profile.select(
        "segment", "variable", "n", F.round("null_pct", 6).alias("null_pct"), F.round("mean", 6).alias("mean"),
        "n_distinct", F.round("p50", 6).alias("p50"), "null_pct_light")


@query("drift_by_segment", f"""
WITH {_SEGMENT_SQL},
b AS (SELECT segment, quantity AS x FROM seg WHERE month < {_LAST}),
c AS (SELECT segment, quantity AS x FROM seg WHERE month = {_LAST}),
v AS (SELECT segment, x FROM b UNION SELECT segment, x FROM c),
n AS (SELECT s.segment, (SELECT count(*) FROM b WHERE b.segment IS NOT DISTINCT FROM s.segment) AS nb,
             (SELECT count(*) FROM c WHERE c.segment IS NOT DISTINCT FROM s.segment) AS nc
      FROM (SELECT DISTINCT segment FROM v) s),
d AS (SELECT v.segment, v.x, sum(coalesce(kb, 0)) OVER w AS cb, sum(coalesce(kc, 0)) OVER w AS cc
      FROM v LEFT JOIN (SELECT segment, x, count(*) AS kb FROM b GROUP BY ALL) i
             ON v.segment IS NOT DISTINCT FROM i.segment AND v.x = i.x
           LEFT JOIN (SELECT segment, x, count(*) AS kc FROM c GROUP BY ALL) j
             ON v.segment IS NOT DISTINCT FROM j.segment AND v.x = j.x
      WINDOW w AS (PARTITION BY v.segment ORDER BY v.x))
SELECT d.segment, 'quantity' AS variable, round(max(abs(cb / nb::double - cc / nc::double)), 8) AS ks
FROM d JOIN n ON d.segment IS NOT DISTINCT FROM n.segment WHERE nb > 0 AND nc > 0 GROUP BY d.segment
""")
def drift_by_segment(spark, sf_dir):
    """The quality job by segment: distance of the month's distribution from the history's."""
    return _job(spark, sf_dir).drift.where("variable = 'quantity' and ks is not null").select(
        "segment", "variable", F.round("ks", 8).alias("ks"))


@query("score_distribution", f"""
WITH {_SEGMENT_SQL},
v AS (SELECT segment, month, {_BUCKET_CASE} AS bucket FROM seg WHERE month <= {_LAST}),
m AS (SELECT segment, month, count(*) AS total FROM v GROUP BY segment, month),
l AS (SELECT unnest([{', '.join(repr(x) for x in _LABELS)}]) AS bucket),
k AS (SELECT segment, month, bucket, count(*) AS n FROM v GROUP BY ALL)
SELECT 'pd' AS score, m.segment, m.month, l.bucket, coalesce(k.n, 0)::bigint AS n, m.total::bigint AS total
FROM m CROSS JOIN l LEFT JOIN k ON k.segment IS NOT DISTINCT FROM m.segment AND k.month = m.month AND k.bucket = l.bucket
""")
def score_distribution(spark, sf_dir):
    """The quality job by segment: buckets of the score per month, of the history and the month judged."""
    return _job(spark, sf_dir).scores.select("score", "segment", "month", "bucket", "n", "total")


@query("quality_keys", f"""
WITH {_SEGMENT_SQL}, now AS (SELECT * FROM seg WHERE month = {_LAST})
SELECT segment, count_if(id IS NULL)::bigint AS null_keys, count(id)::bigint AS n_keys, count(DISTINCT id)::bigint AS n_distinct,
       (count(id) - count(DISTINCT id))::bigint AS n_duplicates FROM now GROUP BY segment
""")
def quality_keys(spark, sf_dir):
    """The quality job by segment: its key check."""
    return _job(spark, sf_dir).keys


_SEGMENT_LONG_SQL = ("SELECT segment, month, 'quantity' AS variable, quantity AS x FROM seg "
                     "UNION ALL SELECT segment, month, 'discount', discount FROM seg")


@query("quality_evolution", f"""
WITH {_SEGMENT_SQL}, long AS ({_SEGMENT_LONG_SQL})
SELECT segment, month, variable, count(x)::bigint AS n, round(100.0::double * count_if(x IS NULL) / count(*), 6) AS null_pct,
       round(100.0::double * count_if(x = 0) / count(*), 6) AS zero_pct, round(avg(x), 6) AS mean,
       round(stddev_samp(x), 6) AS std, min(x) AS min, max(x) AS max
FROM long GROUP BY segment, month, variable
""")
def quality_evolution(spark, sf_dir):
    """The quality job by segment: the profile of every month."""
    return _job(spark, sf_dir).evolution.withColumns({
        c: F.round(c, 6) for c in ("null_pct", "zero_pct", "mean", "std")})


@query("quality_histogram", f"""
WITH {_SEGMENT_SQL}, long AS ({_SEGMENT_LONG_SQL}),
now AS (SELECT segment, variable, x FROM long WHERE month = {_LAST} AND x IS NOT NULL),
e AS (SELECT segment, variable, min(x) AS lo, max(x) AS hi FROM now GROUP BY segment, variable),
n AS (SELECT now.segment, now.variable, lo, hi, coalesce(least(floor((x - lo) / ((hi - lo) / 30.0::double))::int + 1, 30), 1) AS bin
      FROM now JOIN e ON now.segment IS NOT DISTINCT FROM e.segment AND now.variable = e.variable)
SELECT segment, variable, bin::int AS bin, round(lo + (bin - 1) * ((hi - lo) / 30.0::double), 6) AS lower, count(*)::bigint AS n
FROM n GROUP BY segment, variable, lo, hi, bin
""")
def quality_histogram(spark, sf_dir):
    """The quality job by segment: histograms of the month judged."""
    return _job(spark, sf_dir).histogram.select("segment", "variable", "bin", F.round("lower", 6).alias("lower"), "n")


_KPI_SQL = f"""
WITH {_SEGMENT_SQL}, long AS ({_SEGMENT_LONG_SQL}),
m AS (SELECT segment, variable, 100.0::double * count_if(x IS NULL) / count(*) AS nulls,
             100.0::double * count_if(x = 0) / count(*) AS zeros FROM long WHERE month = {_LAST} GROUP BY segment, variable),
l AS (SELECT segment, CASE WHEN nulls >= 20 OR zeros >= 90 THEN 'red' WHEN nulls >= 5 OR zeros >= 50 THEN 'yellow'
                           ELSE 'green' END AS light FROM m)
SELECT segment, count(*)::bigint AS n_variables, count_if(light = 'green')::bigint AS green,
       count_if(light = 'yellow')::bigint AS yellow, count_if(light = 'red')::bigint AS red FROM l GROUP BY segment
"""


@query("quality_kpis", _KPI_SQL)
def quality_kpis(spark, sf_dir):
    """The quality job by segment: lights of its variables."""
    return _job(spark, sf_dir).kpis


@query("metric_bundle", _KPI_SQL)
def metric_bundle(spark, sf_dir):
    """All tables of the quality job written as a JSON bundle; the lights read back from it."""
    path = new_folder(spark, "metrics")
    sinks.write_metrics(_job(spark, sf_dir).frames(), path)
    kinds = "segment string, n_variables long, green long, yellow long, red long"
    return spark.read.schema(kinds).json(f"{path}/kpis")


_PROBS = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
#: Bounds of the errors: of distinct values as a share of them, of ranks as a share of the values.
_DISTINCT_ERROR, _RANK_ERROR = 0.06, 0.025


@query("sketch_bounds", f"""
WITH {_LINES_SQL}, p AS ({_each('''
SELECT '{c}' AS variable, count({c})::bigint AS n, round(100.0::double * count_if({c} IS NULL) / count(*), 6) AS null_pct,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max FROM lines''')})
SELECT way, p.*, true AS distinct_within, true AS ranks_within FROM p, (SELECT unnest(['monthly state', 'one pass']) AS way)
""")
def sketch_bounds(spark, sf_dir):
    """Profiles of all months merged from the monthly state, and of one approximate pass, held against exact values.

    The state is written in two updates, and the last month is profiled once more.
    """
    lines = _lines(spark, sf_dir)
    path, last = new_folder(spark, "state"), _last_month(spark, sf_dir)
    months = months_mod.observed_months(table(spark, sf_dir, "lineitem"), "l_shipdate", month_key)
    for part in (months[:-3], months[-3:], [last]):
        sketches.update_state(lines, path, COLUMNS, part)
    merged = sketches.merged_profile(sketches.read_state(spark, path), _PROBS)
    passed = profile.variable_profile(lines, COLUMNS, exact=False)
    exact = lines.agg(*[F.count_distinct(c).alias(c) for c in COLUMNS]).unpivot([], COLUMNS, "variable", "exact")
    kept = ["variable", "n", "null_pct", "mean", "std", "min", "max", "n_distinct", *_PROBS]
    out = None
    for way, found in (("monthly state", merged), ("one pass", passed)):
        found = staged(found.select(*kept), "profile")
        errors = sketches.rank_errors(lines, found, _PROBS).select("variable", F.greatest(*_PROBS).alias("__rank"))
        held = found.join(exact, "variable").join(errors, "variable").select(
            F.lit(way).alias("way"), "variable", "n", F.round("null_pct", 6).alias("null_pct"), F.round("mean", 6).alias("mean"),
            F.round("std", 6).alias("std"), "min", "max",
            (F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), _DISTINCT_ERROR * F.col("exact"))).alias("distinct_within"),
            (F.col("__rank") <= _RANK_ERROR).alias("ranks_within"))
        out = held if out is None else out.unionByName(held)
    return out


@query("sketch_evolution", f"""
WITH {_EVOLUTION_SQL}
SELECT variable, month, n, round(null_pct, 6) AS null_pct, round(mean, 6) AS mean, round(std, 6) AS std FROM evo
""")
def sketch_evolution(spark, sf_dir):
    """The months of the stored state, without the table they are from."""
    path = new_folder(spark, "state")
    months = months_mod.observed_months(table(spark, sf_dir, "lineitem"), "l_shipdate", month_key)
    sketches.update_state(_lines(spark, sf_dir), path, COLUMNS, months)
    out = sketches.evolution(sketches.read_state(spark, path))
    return out.select("variable", "month", "n", *[F.round(c, 6).alias(c) for c in ("null_pct", "mean", "std")])


@query("key_check_bounds", f"""
WITH {PORTFOLIO_SQL}
SELECT count_if(account IS NULL)::bigint AS null_keys, count(account)::bigint AS n_keys, true AS distinct_within FROM portfolio
""")
def key_check_bounds(spark, sf_dir):
    """The approximate key check against the exact one."""
    p = portfolio(spark, sf_dir)
    rough = profile.key_check(p, "account", exact=False).withColumnRenamed("n_distinct", "__rough")
    exact = profile.key_check(p, "account").select("n_distinct", F.col("n_keys").alias("__keys"))
    both = rough.join(exact, F.col("n_keys") == F.col("__keys"))
    return both.select("null_keys", "n_keys", (F.abs(F.col("__rough") - F.col("n_distinct")) <= 0.15 * F.col("n_distinct")).alias("distinct_within"))

"""Scores, bands, models and segment routing on the test tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from panelscore.catalog.mapping import (CUSTOMER_PD_SQL, PORTFOLIO_SQL, customer_pd, log_odds_sql, portfolio, table)
from panelscore.catalog.registry import query
from panelscore.functions import scoring
from panelscore.operators import enrich, joins, models
from panelscore.plans import jobs

INTERCEPT, SLOPE = -0.75, 0.85

_XB = log_odds_sql("pd")


@query("logit_points", f"""
WITH {CUSTOMER_PD_SQL}, x AS (SELECT *, {_XB} AS xb FROM customer_pd)
SELECT party, round(xb, 8) AS xb,
  CASE WHEN xb IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb, 0)) END AS points,
  CASE WHEN xb IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb, 1)) END AS points_1
FROM x
""")
def logit_points(spark, sf_dir):
    xb = scoring.log_odds("pd")
    return customer_pd(spark, sf_dir).select(
        "party", F.round(xb, 8).alias("xb"), scoring.points(xb).alias("points"),
        scoring.points(xb, digits=1).alias("points_1"))


@query("recalibrate_band", f"""
WITH {CUSTOMER_PD_SQL}, {PORTFOLIO_SQL},
x AS (SELECT *, {_XB} AS xb FROM customer_pd),
cal AS (SELECT party, xb, {INTERCEPT}::double + {SLOPE}::double * xb AS xb_cal FROM x),
scored AS (SELECT party, round(xb_cal, 8) AS xb_cal, round(1 / (1 + exp(-xb_cal)), 8) AS pd_cal,
  CASE WHEN xb_cal IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb_cal, 1)) END AS points,
  CASE WHEN 1 / (1 + exp(-xb_cal)) < 0.02 THEN 'low' WHEN 1 / (1 + exp(-xb_cal)) < 0.07 THEN 'watch' ELSE 'high' END AS band
  FROM cal),
accounts AS (SELECT party, count(account)::bigint AS n_accounts, max(maturity)::int AS worst, min(product) AS first_product
             FROM portfolio WHERE status <> 'O' GROUP BY party)
SELECT party, xb_cal, pd_cal, points, band, n_accounts, worst, first_product,
       (n_accounts IS NOT NULL)::int AS in_portfolio, (band IS NOT NULL)::int AS in_scores
FROM accounts FULL JOIN scored USING (party)
""")
def recalibrate_band(spark, sf_dir):
    xb_cal = scoring.linear(scoring.log_odds("pd"), INTERCEPT, SLOPE)
    pd_cal = scoring.inverse_logit(xb_cal)
    scored = customer_pd(spark, sf_dir).select(
        "party", F.round(xb_cal, 8).alias("xb_cal"), F.round(pd_cal, 8).alias("pd_cal"),
        scoring.points(xb_cal, digits=1).alias("points"), scoring.risk_band(pd_cal).alias("band"))
    accounts = (portfolio(spark, sf_dir).filter(F.col("status") != "O").groupBy("party")
                .agg(F.count("account").alias("n_accounts"), F.max("maturity").alias("worst"),
                     F.min("product").alias("first_product")))
    return joins.with_side_flags(accounts, scored, ["party"], "full", ("in_portfolio", "in_scores"))


_MODEL_A = {models.INTERCEPT: -2.0, "acctbal": -0.0002, "nation": 0.05}
_MODEL_B = {models.INTERCEPT: -1.0, "acctbal": -0.0004}


def _linear_sql(m):
    terms = [f"{m[models.INTERCEPT]}::double"] + [f"{w}::double * {f}" for f, w in m.items() if f != models.INTERCEPT]
    return " + ".join(terms)


@query("segment_scores", f"""
WITH {CUSTOMER_PD_SQL}
SELECT party, 1::int AS segment_id, round(1 / (1 + exp(-({_linear_sql(_MODEL_A)}))), 8) AS pd_raw
FROM customer_pd WHERE segment IN ('BUILDING', 'MACHINERY')
UNION ALL
SELECT party, 2::int, round(1 / (1 + exp(-({_linear_sql(_MODEL_B)}))), 8) FROM customer_pd
WHERE segment NOT IN ('BUILDING', 'MACHINERY') AND acctbal > 0
""")
def segment_scores(spark, sf_dir):
    out = models.score_segments(customer_pd(spark, sf_dir), [
        (1, "segment IN ('BUILDING', 'MACHINERY')", _MODEL_A), (2, F.col("acctbal") > 0, _MODEL_B)])
    return out.select("party", "segment_id", F.round("pd_raw", 8).alias("pd_raw"))


@query("model_table_score", f"""
WITH {CUSTOMER_PD_SQL}
SELECT party, segment, round(1 / (1 + exp(-({_linear_sql(_MODEL_A)}))), 8) AS numpd FROM customer_pd
""")
def model_table_score(spark, sf_dir):
    """The model is a table of coefficients; only the generated column goes back to the master."""
    master = customer_pd(spark, sf_dir)
    model = spark.createDataFrame(list(_MODEL_A.items()), "feature string, coefficient double")
    scored = models.score_linear(master, model, "numpd").withColumn("numpd", F.round("numpd", 8))
    return enrich.attach_generated(master.select("party", "segment"), scored, ["party"], ["numpd"])


@query("vectorised_score", f"""
WITH {CUSTOMER_PD_SQL}
SELECT party, round(1 / (1 + exp(-({_linear_sql(_MODEL_A)}))), 8) AS numpd FROM customer_pd
""")
def vectorised_score(spark, sf_dir):
    names = [f for f in _MODEL_A if f != models.INTERCEPT]
    weights = np.array([_MODEL_A[f] for f in names])
    bias = _MODEL_A[models.INTERCEPT]

    def predict(batch):
        return 1.0 / (1.0 + np.exp(-(batch.to_numpy() @ weights + bias)))

    out = models.score_vectorised(customer_pd(spark, sf_dir), names, predict, "numpd")
    return out.select("party", F.round("numpd", 8).alias("numpd"))


_TREES = [
    {"tree": 0, "node": 0, "feature": "acctbal", "threshold": 2500.0, "yes": 1, "no": 2, "value": None},
    {"tree": 0, "node": 1, "feature": "nation", "threshold": 11.5, "yes": 3, "no": 4, "value": None},
    {"tree": 0, "node": 2, "feature": None, "threshold": None, "yes": None, "no": None, "value": -1.5},
    {"tree": 0, "node": 3, "feature": None, "threshold": None, "yes": None, "no": None, "value": 0.25},
    {"tree": 0, "node": 4, "feature": None, "threshold": None, "yes": None, "no": None, "value": 0.75},
    {"tree": 1, "node": 0, "feature": "pd", "threshold": 0.25, "yes": 1, "no": 2, "value": None},
    {"tree": 1, "node": 1, "feature": None, "threshold": None, "yes": None, "no": None, "value": -0.5},
    {"tree": 1, "node": 2, "feature": None, "threshold": None, "yes": None, "no": None, "value": 0.5},
]


@query("tree_table_score", f"""
WITH {CUSTOMER_PD_SQL},
s AS (SELECT party, CASE WHEN acctbal <= 2500 THEN CASE WHEN nation <= 11.5 THEN 0.25 ELSE 0.75 END ELSE -1.5 END
             + CASE WHEN pd <= 0.25 THEN -0.5 ELSE 0.5 END AS margin FROM customer_pd)
SELECT party, round(1 / (1 + exp(-margin::double)), 8) AS numpd FROM s
""")
def tree_table_score(spark, sf_dir):
    out = models.score_trees(customer_pd(spark, sf_dir), _TREES, ["acctbal", "nation", "pd"], "numpd")
    return out.select("party", F.round("numpd", 8).alias("numpd"))


@query("score_panel", f"""
WITH {PORTFOLIO_SQL}, {CUSTOMER_PD_SQL},
m AS (SELECT DISTINCT month, party FROM portfolio),
r AS (SELECT m.month, m.party, 1 / (1 + exp(-({_linear_sql(_MODEL_A)}))) AS pd_raw FROM m JOIN customer_pd c USING (party)),
x AS (SELECT *, {INTERCEPT}::double + {SLOPE}::double * ({log_odds_sql('pd_raw')}) AS xb FROM r)
SELECT month, party, round(pd_raw, 8) AS pd_raw, round(xb, 8) AS numxb, round(1 / (1 + exp(-xb)), 8) AS numpd,
       CASE WHEN xb IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb, 0)) END AS numscore FROM x
""")
def score_panel(spark, sf_dir):
    """The whole panel through model, log-odds, recalibration and points."""
    months = portfolio(spark, sf_dir).select("month", "party").distinct()
    panel = months.join(customer_pd(spark, sf_dir), "party")
    names = [f for f in _MODEL_A if f != models.INTERCEPT]
    out = jobs.score_panel(panel, lambda df: models.score_linear(df, _MODEL_A), names, (INTERCEPT, SLOPE))
    return out.select("month", "party", *[F.round(c, 8).alias(c) for c in ("pd_raw", "numxb", "numpd")], "numscore")


_ROUTED_SQL = """
c AS (SELECT c_custkey AS party, c_acctbal::double AS acctbal, c_nationkey::double AS nation,
             CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment FROM customer),
r AS (SELECT party, 1 AS segment_id, round(1 / (1 + exp(1.0::double + acctbal / 4000)), 8) AS pd_raw FROM c WHERE segment = 'BUILDING'
      UNION ALL SELECT party, 2, round(nation / 50.0::double, 8) FROM c WHERE acctbal > 5000 OR segment = 'HOUSEHOLD'
      UNION ALL SELECT party, 3, round(1 / (1 + exp(nation / 10)), 8) FROM c WHERE segment IS NOT NULL AND segment <> 'BUILDING')"""


def _routed(spark, sf_dir, overlap):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nation"),
        segment.alias("segment"))
    by_segment = [(1, "segment = 'BUILDING'", ["acctbal"], lambda b: 1 / (1 + np.exp(1.0 + b["acctbal"] / 4000))),
                  (2, "acctbal > 5000 or segment = 'HOUSEHOLD'", ["nation"], lambda b: b["nation"] / 50.0),
                  (3, "segment <> 'BUILDING'", ["nation"], lambda b: 1 / (1 + np.exp(b["nation"] / 10)))]
    out = models.score_routed(customers, by_segment, overlap)
    return out.select("party", "segment_id", F.round("pd_raw", 8).alias("pd_raw"))


@query("routed_models", f"""
WITH {_ROUTED_SQL} SELECT party, min(segment_id)::int AS segment_id, arg_min(pd_raw, segment_id) AS pd_raw FROM r GROUP BY party
""")
def routed_models(spark, sf_dir):
    """Three Python models in one pass; a customer goes to the first segment it is in, of which one is missing."""
    return _routed(spark, sf_dir, "first")


@query("routed_models_overlapping", f"WITH {_ROUTED_SQL} SELECT party, segment_id::int AS segment_id, pd_raw FROM r")
def routed_models_overlapping(spark, sf_dir):
    """The same with a row for each segment a customer is in."""
    return _routed(spark, sf_dir, "all")

"""Monthly jobs on the test tables: panels, back-fill, publishing, availability, inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscore.catalog.mapping import (CUSTOMER_MONTH_SQL, CUSTOMER_PD_SQL, PORTFOLIO_SQL, SHIPPED_SQL, customer_month,
                                        customer_pd, log_odds_sql, portfolio, scratch, shift_sql, shipped_items, table)
from panelscore.catalog.registry import query
from panelscore.functions.months import add_months, month_key, month_list, observed_months
from panelscore.operators import joins, models, rollup, shape
from panelscore.plans import business, jobs, retail
from panelscore.sources import control, sinks, tables

# ---- inventory, availability, missing months ------------------------------------------------


@query("source_inventory", """
SELECT 'orders' AS table_name, count(*)::bigint AS n_rows, 6::int AS n_columns, (min(year(o_orderdate) * 100 + month(o_orderdate)))::int AS first_month,
       (max(year(o_orderdate) * 100 + month(o_orderdate)))::int AS last_month FROM orders
UNION ALL SELECT 'lineitem', count(*)::bigint, 11::int, (min(year(l_shipdate) * 100 + month(l_shipdate)))::int,
       (max(year(l_shipdate) * 100 + month(l_shipdate)))::int FROM lineitem
UNION ALL SELECT 'customer', count(*)::bigint, 5::int, NULL::int, NULL::int FROM customer
UNION ALL SELECT 'part', count(*)::bigint, 6::int, NULL::int, NULL::int FROM part
UNION ALL SELECT 'supplier', count(*)::bigint, 4::int, NULL::int, NULL::int FROM supplier
""")
def source_inventory(spark, sf_dir):
    names = ("orders", "lineitem", "customer", "part", "supplier")
    return tables.inventory({n: table(spark, sf_dir, n) for n in names},
                            {"orders": month_key("o_orderdate"), "lineitem": month_key("l_shipdate")})


@query("rows_per_month", f"WITH {PORTFOLIO_SQL} SELECT month, count(*)::bigint AS n_rows FROM portfolio GROUP BY month")
def rows_per_month(spark, sf_dir):
    return rollup.rows_per_month(portfolio(spark, sf_dir), "month")


_REF = 200108


def _avail_sql(name: str, date: str, lag: int) -> str:
    m = f"(year({date}) * 100 + month({date}))::int"
    exp = add_months(_REF, lag)
    return (f"SELECT '{name}' AS table_name, {exp}::int AS expected_month, max({m})::int AS last_month, "
            f"count_if({m} = {exp})::bigint AS n_rows, (count_if({m} = {exp}) > 0)::int AS available FROM {name}")


@query("availability", _avail_sql("orders", "o_orderdate", -1) + "\nUNION ALL "
       + _avail_sql("lineitem", "l_shipdate", 0) + "\nUNION ALL " + _avail_sql("events", "ts", 0))
def availability(spark, sf_dir):
    rows = [control.ControlRow("orders", month_key("o_orderdate"), -1),
            control.ControlRow("lineitem", month_key("l_shipdate"), 0),
            control.ControlRow("events", month_key("ts"), 0)]
    return control.availability(rows, lambda name: table(spark, sf_dir, name), _REF)


_WANTED = month_list(199410, 200201)


@query("missing_months", f"""
WITH {PORTFOLIO_SQL}
SELECT m::int AS month FROM (SELECT unnest({_WANTED}) AS m) WHERE m NOT IN (SELECT month FROM portfolio)
""")
def missing_months(spark, sf_dir):
    present = tables.months_present(portfolio(spark, sf_dir), "month")
    return control.missing_months(present, _WANTED)


# ---- sinks ----------------------------------------------------------------------------------


@query("struct_publish", f"""
WITH {CUSTOMER_MONTH_SQL}
SELECT month, party::varchar AS party, (1 / (1 + balance::double / 1000.0))::decimal(19,8)::double AS numpd,
       balance::double AS balance, n_accounts::int::varchar AS n_accounts, NULL::varchar AS absent
FROM customer_month
""")
def struct_publish(spark, sf_dir):
    """Packed, written by month, read back and flattened."""
    cm = customer_month(spark, sf_dir)
    scores = cm.select(F.col("month").alias("MONTH"), F.col("party").alias("Party"),
                       (F.lit(1.0) / (F.lit(1.0) + F.col("balance").cast("double") / 1000.0)).alias("numpd"),
                       F.col("balance").cast("double").alias("balance"),
                       F.col("n_accounts").cast("double").alias("n_accounts"))
    path = scratch(spark, "publish")
    jobs.publish(scores, path, {"party": ("party", "string"), "numpd": ("numpd", "decimal(19,8)"),
                                "absent": ("not_there", "string"), "month": ("month", "int")},
                 "variables", {"n_accounts": "string"})
    flat = shape.flatten(spark.read.parquet(path), ["model_variables", "variables"])
    return flat.select("month", "party", F.col("numpd").cast("double").alias("numpd"), "balance", "n_accounts", "absent")


@query("publish_check", f"""
WITH {PORTFOLIO_SQL}
SELECT month, count(*)::bigint AS n_source, count(*)::bigint AS n_written, 1::int AS ok FROM portfolio GROUP BY month
""")
def publish_check(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    return jobs.publish(p, scratch(spark, "publish"), {"account": ("account", "string"), "month": ("month", "int")},
                        "variables")


@query("month_backfill", f"""
WITH {CUSTOMER_MONTH_SQL}
SELECT month, party, CASE WHEN month BETWEEN 200106 AND 200108 THEN 2 ELSE 1 END::int AS version,
       balance::double AS balance FROM customer_month
""")
def month_backfill(spark, sf_dir):
    """All months written once; the last three are then rebuilt and replaced one by one."""
    cm = shape.as_double(customer_month(spark, sf_dir).select("month", "party", "balance"))
    path = scratch(spark, "backfill")
    sinks.write_months(cm.withColumn("version", F.lit(1)), path, mode="all")
    last = tables.month_slice(cm, "month", 200106, 200108).withColumn("version", F.lit(2))
    results = jobs.backfill(lambda m: tables.month_slice(last, "month", m), path, 200108, 2)
    failed = [r for r in results if not r.ok]
    if failed:
        raise RuntimeError(f"back-fill failed: {failed}")
    return spark.read.parquet(path).select("month", "party", "version", "balance")


#: Months that the score job replaces, and months that the rebuild finds missing.
_SCORED, _LOST = [200105, 200106, 200107], (200102, 200104)


@query("score_months", f"""
WITH {PORTFOLIO_SQL}, {CUSTOMER_PD_SQL},
r AS (SELECT DISTINCT p.month, p.party, -1.0::double - 0.0004::double * c.acctbal AS xb
      FROM portfolio p JOIN customer_pd c USING (party) WHERE p.month BETWEEN {_SCORED[0]} AND {_SCORED[-1]}),
s AS (SELECT month, CASE WHEN xb IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb, 0)) END AS v
      FROM r)
SELECT month, count(*)::bigint AS n_rows, count_if(v IS NULL)::bigint AS n_null, min(v) AS min, max(v) AS max,
       round(avg(v), 6) AS mean FROM s GROUP BY month
""")
def score_months(spark, sf_dir):
    """Months are scored and replaced one by one; the table is summarised as it is on disk."""
    panel = portfolio(spark, sf_dir).select("month", "party").distinct().join(customer_pd(spark, sf_dir), "party")
    model = {models.INTERCEPT: -1.0, "acctbal": -0.0004}
    path = scratch(spark, "scores")
    for _ in range(2):  # a second run replaces the first
        results = jobs.score_months(panel, path, _SCORED, lambda df: models.score_linear(df, model), ["acctbal"])
        if not all(r.ok for r in results):
            raise RuntimeError(f"scoring failed: {results}")
    return jobs.score_summary(spark, path).withColumn("mean", F.round("mean", 6))


@query("rebuild_missing_months", f"""
WITH {CUSTOMER_MONTH_SQL}
SELECT month, count(*)::bigint AS n_rows, CASE WHEN month BETWEEN {_LOST[0]} AND {_LOST[1]} THEN 2 ELSE 1 END::int AS version
FROM customer_month GROUP BY month
""")
def rebuild_missing_months(spark, sf_dir):
    """A table that lacks its months at both ends of a range: what lies between them is rebuilt as well."""
    cm = customer_month(spark, sf_dir).select("month", "party")
    path = scratch(spark, "rebuild")
    sinks.write_months(cm.where(~F.col("month").isin(*_LOST)).withColumn("version", F.lit(1)), path, mode="all")
    required = [r["month"] for r in cm.select("month").distinct().collect()]  # one number a month
    jobs.rebuild_missing(spark, path, required,
                         lambda m: tables.month_slice(cm, "month", m).withColumn("version", F.lit(2)))
    return spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n_rows"), F.max("version").alias("version"))


@query("control_gate", f"""
WITH {CUSTOMER_MONTH_SQL},
c AS (SELECT 'portfolio' AS table_name, 200107 AS expected_month UNION ALL SELECT 'customers', 200106
      UNION ALL SELECT 'later', 200207),
m AS (SELECT 'portfolio' AS table_name, month FROM portfolio UNION ALL SELECT 'customers', month FROM customer_month
      UNION ALL SELECT 'later', month FROM portfolio)
SELECT c.table_name, c.expected_month::int AS expected_month, max(m.month)::int AS last_month,
       count_if(m.month = c.expected_month)::bigint AS n_rows,
       CASE WHEN count_if(m.month = c.expected_month) > 0 THEN 1 ELSE 0 END::int AS available
FROM c JOIN m USING (table_name) GROUP BY c.table_name, c.expected_month
""")
def control_gate(spark, sf_dir):
    """Control rows written as CSV and read back, the verdict per source, and the gate that it decides."""
    path = scratch(spark, "control")
    rows = [("app", "portfolio", "month", 0), ("app", "customers", "month", -1), ("app", "later", "month", 12)]
    spark.createDataFrame(rows, control.CONTROL_SCHEMA).write.option("header", "true").csv(path)
    p = portfolio(spark, sf_dir)
    report = control.availability(control.read_control(spark, path), {
        "portfolio": p, "customers": customer_month(spark, sf_dir), "later": p}, 200107)
    try:
        control.require_available(report)
    except ValueError:
        return report
    raise RuntimeError("the gate let a missing source pass")


@query("chunk_export", f"""
WITH {PORTFOLIO_SQL}
SELECT month, account, party, balance::double AS balance FROM portfolio
""")
def chunk_export(spark, sf_dir):
    path = scratch(spark, "chunks")
    p = shape.as_double(portfolio(spark, sf_dir).select("month", "account", "party", "balance"))
    sinks.export_chunks(p, path)
    return tables.read_folders(spark, [path])


@query("vulnerability", f"""
WITH {PORTFOLIO_SQL}, {CUSTOMER_PD_SQL},
people AS (SELECT month, party, count(*)::bigint AS n_accounts, max(maturity)::int AS target, min(product) AS level
           FROM portfolio WHERE status = 'O' GROUP BY month, party),
months AS (SELECT DISTINCT month, party FROM portfolio WHERE status <> 'P'),
x AS (SELECT m.month, m.party, c.pd AS numpd, -1.4383977166087802::double + 1.1506739569389508::double * ({log_odds_sql('pd')}) AS xb
      FROM months m JOIN customer_pd c USING (party)),
s AS (SELECT *, 1 / (1 + exp(-xb)) AS cal FROM x)
SELECT month, party, n_accounts, target, level, round(numpd, 8) AS numpd, round(xb, 6) AS xb_cal, round(cal, 8) AS pd_cal,
  CASE WHEN xb IS NOT NULL THEN greatest(3.0::double, round(174.25::double - 57.708::double * xb, 1)) END AS points,
  CASE WHEN cal < 0.02 THEN 'low' WHEN cal < 0.07 THEN 'watch' ELSE 'high' END AS band
FROM people JOIN s USING (month, party)
""")
def vulnerability(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    accounts = p.filter(F.col("status") == "O").select("month", "party", F.col("maturity").alias("target"),
                                                       F.col("product").alias("level"))
    months = p.filter(F.col("status") != "P").select("month", "party").distinct()
    scores = months.join(customer_pd(spark, sf_dir).select("party", F.col("pd").alias("numpd")), "party")
    # Recalibration of the 30/12 to the 30/3 definition.
    out = jobs.vulnerability(accounts, scores, -1.4383977166087802, 1.1506739569389508)
    return out.withColumns({"numpd": F.round("numpd", 8), "xb_cal": F.round("xb_cal", 6),
                            "pd_cal": F.round("pd_cal", 8)})


# ---- panels ---------------------------------------------------------------------------------

_FEAT_SQL = f"{PORTFOLIO_SQL}, {SHIPPED_SQL}"


def feature_table(spark, sf_dir):
    """Customer-month features, staged once: some twenty role tables are cut from it."""
    feat = shape.as_double(shipped_items(spark, sf_dir))
    return sinks.stage(feat, scratch(spark, "features"))


def retail_portfolio(spark, sf_dir):
    pr = F.col("product")
    padded = F.concat(F.lit(" "), F.col("party").cast("string"), F.lit("  "))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), "c_acctbal")
    unique = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("U"), F.call_function("div", F.col("party"), F.lit(2)).cast("string")))
    return joins.lookup_join(portfolio(spark, sf_dir), c, ["party"], "inner").select(
        "month", padded.alias("party_id"), unique.alias("unique_id"),
        F.when(F.col("account") % 10 != 0, F.col("account").cast("string")).alias("internal_id"),
        F.col("maturity").alias("maturity_months"), (F.col("maturity") * 2).alias("days_past_due"),
        F.when(F.col("status") != "P", F.lit("1 ")).otherwise(F.lit("0")).alias("valid_flag"),
        F.when(pr == "1-URGENT", F.lit("VP ")).otherwise(F.lit("ALS")).alias("app"),
        F.when(pr.isin("1-URGENT", "5-LOW"), F.lit("TARJETA")).when(pr == "4-NOT SPECIFIED", F.lit(" HIPOTECARIO"))
        .otherwise(F.lit("CONSUMO")).alias("product_l0"),
        F.when(pr == "2-HIGH", F.lit("04. Consumo ")).when(pr == "3-MEDIUM", F.lit("05. Vehicular")).alias("product_l1"),
        F.when(F.col("status") == "F", F.lit("1")).otherwise(F.lit("0")).alias("personal_card_flag"),
        F.col("balance").alias("balance_local"))


def retail_tables(spark, feat):
    party = F.col("party").cast("string").alias("party_id")
    f = feat.select("*", party)
    by_unique = (feat.groupBy("month", F.concat(F.lit("U"), F.call_function("div", F.col("party"), F.lit(2)).cast("string"))
                              .alias("unique_id"))
                 .agg(F.max("discount").alias("discount"), F.max("quantity").alias("quantity")))
    flag = lambda cond: F.when(cond, F.lit("1")).otherwise(F.lit("0"))
    c = F.col

    def t(**cols):
        return f.select("month", "party_id", *[e.alias(n) for n, e in cols.items()])

    def u(**cols):
        return by_unique.select("month", "unique_id", *[e.alias(n) for n, e in cols.items()])

    birth = F.date_add(F.lit("1940-01-01").cast("date"), (c("party") * 17 % 25000).cast("int"))
    return {
        "income_months": t(income_months_24m=c("n_items").cast("int")),
        "guarantees": t(guarantee_amount=F.when(c("tax") == 0.08, 99999.0).otherwise(c("price"))),
        "balance_flag": t(savings_over_300_flag=F.when(c("quantity") > 100, 1).otherwise(0)),
        "demographics": t(birth_date=birth),
        "other_debt": u(revolving_share_3m=c("discount") / 2),
        "debt_by_product": t(
            indirect_debt_3m=c("price"), debt_ratio_3_24=c("discount"), debt_ratio_12_24=c("tax"),
            active_months_3m=c("n_items"), max_debt_12m=F.when(c("n_items") != 1, c("price") - 50000),
            max_debt_24m=F.when(c("discount") == 0.1, 0.0).otherwise(c("price") * 0.5)),
        "experience": t(debt_evolution_3_6=c("tax"), overdue_days_max_24m=c("quantity").cast("int")),
        "card_billing": u(full_payment_flag_3m=c("discount") * 8),
        "card_billing_txn": t(min_payment_share_6m=c("tax") * 1000),
        "network_interaction": t(risky_contacts_max_3m=c("discount")),
        "network_attribute": t(provision_cost_share_3m=c("tax")),
        "weighted_arrears": t(weighted_debt_48m=F.when(c("n_items") == 2, 1111111111.0).otherwise(c("price"))),
        "deposits": t(atm_operations_3m=c("tax") * 5),
        "service_payments": t(service_payment_months_3m=c("n_items")),
        "asset_liability": t(liability_asset_share_24m=c("price") / 1000, min_savings_6m=c("discount") * 8),
        "pos": u(pos_ticket_3m=c("quantity")),
        "pos_other": t(pos_share_6m=c("discount")),
        "education": t(bachelor_flag=flag(c("discount") > 0.09), doctor_flag=F.lit(None).cast("string"),
                       master_flag=F.lit("0"), degree_flag=flag(c("tax") > 0.07)),
    }


#: The columns of the role tables that hold codes; sums of prices and balances may be 99999 like any other number.
RETAIL_CODES = {"guarantee_amount": [99999], "weighted_debt_48m": [1111111111]}


def _clip_sql(x, lo, hi):
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest(({x})::double, {lo}), {hi}) END"


def _ratio_sql(a, b):
    """Sentinel cases of the ratio are nulls after cleaning."""
    return f"CASE WHEN {a} = 0 AND {b} <> 0 THEN 0 WHEN {b} <> 0 THEN round({a} / {b}, 8) END"


_RETAIL_SQL = f"""
WITH {_FEAT_SQL},
acc AS (SELECT p.*, CASE WHEN c.c_acctbal >= 0 THEN 'U' || (p.party // 2)::varchar END AS unique_id,
               CASE WHEN account % 10 <> 0 THEN account::varchar END AS internal_id
        FROM portfolio p JOIN customer c ON c.c_custkey = p.party
        WHERE account % 10 <> 0 AND product <> '5-LOW'),
rolled AS (SELECT month, party::varchar AS party_id, party, max(internal_id) AS internal_id, max(unique_id) AS unique_id,
  coalesce(max(CASE WHEN status <> 'P' THEN 1 END), 0) AS is_valid,
  coalesce(max(CASE WHEN status <> 'P' THEN maturity * 2 END), 0) AS days_past_due,
  coalesce(max(CASE WHEN status <> 'P' THEN maturity END), 0) AS max_maturity,
  coalesce(max(CASE WHEN status <> 'P' AND product = '1-URGENT' THEN (status = 'F')::int END), 0) AS flag_personal_card,
  coalesce(sum(CASE WHEN status <> 'P' AND balance > 0 THEN balance END), 0) AS balance_local,
  coalesce(max(CASE WHEN status <> 'P' AND product = '1-URGENT' THEN 1 END), 0) AS flag_card,
  coalesce(max(CASE WHEN status <> 'P' AND product = '2-HIGH' THEN 1 END), 0) AS flag_cash,
  coalesce(max(CASE WHEN status <> 'P' AND product = '3-MEDIUM' THEN 1 END), 0) AS flag_vehicle,
  coalesce(max(CASE WHEN status <> 'P' AND product = '4-NOT SPECIFIED' THEN 1 END), 0) AS flag_mortgage
  FROM acc GROUP BY month, party),
base AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY month, coalesce(unique_id, 'none' || party_id)
         ORDER BY party_id DESC) AS i FROM rolled) WHERE i = 1),
arr AS (SELECT month, party, max(maturity) AS v FROM portfolio WHERE status <> 'O' GROUP BY month, party),
u AS (SELECT month, 'U' || (party // 2)::varchar AS unique_id, max(discount) AS discount, max(quantity) AS quantity
      FROM items GROUP BY ALL),
j AS (SELECT b.*, {', '.join(f'a{k}.v AS a{k}' for k in range(6))},
  f.quantity AS fq, f.price::double AS fp, f.discount AS fd, f.tax AS ft, f.n_items AS fn,
  g.quantity AS gq, g.price::double AS gp, g.discount AS gd, g.tax AS gt, g.n_items AS gn,
  u.discount AS ud, u.quantity AS uq,
  CASE WHEN f.party IS NOT NULL THEN DATE '1940-01-01' + (b.party * 17 % 25000)::int END AS birth,
  last_day(make_date(b.month // 100, b.month % 100, 1)) AS ref
  FROM base b
  {' '.join(f"LEFT JOIN arr a{k} ON a{k}.party = b.party AND {shift_sql(f'a{k}.month', k)} = b.month" for k in range(6))}
  LEFT JOIN items f ON f.party = b.party AND f.month = b.month
  LEFT JOIN items g ON g.party = b.party AND {shift_sql('g.month', 1)} = b.month
  LEFT JOIN u ON u.unique_id = b.unique_id AND u.month = b.month),
d AS (SELECT *, greatest(a0, a1, a2)::double AS u3m, greatest(a3, a4, a5)::double AS p3m,
  CASE WHEN fn <> 1 THEN fp - 50000 END AS d12, CASE WHEN fd = 0.1 THEN 0 WHEN fp IS NOT NULL THEN fp * 0.5 END AS d24,
  CASE WHEN birth <= ref THEN ((year(ref) - year(birth)) * 12 + month(ref) - month(birth)) // 12 END AS age FROM j)
SELECT month, party_id, unique_id, internal_id, days_past_due::double AS days_past_due, is_valid::double AS is_valid,
  balance_local::double AS balance_local, flag_card::int AS flag_card, flag_personal_card::int AS flag_personal_card,
  flag_cash::int AS flag_cash, flag_vehicle::int AS flag_vehicle, flag_mortgage::int AS flag_mortgage,
  {_clip_sql('a0', 1, 30)} AS arrears_0_cap, max_maturity::double AS max_maturity,
  {_clip_sql('greatest(u3m, p3m)', 1, 32)} AS arrears_max_u6m_cap, ft AS debt_evolution_3_6,
  round({_clip_sql('gp / 1000', 0.00692478, 117.23953515)}, 8) AS liability_asset_share_24m_cap,
  round({_clip_sql('ft * 1000', 0, 26.23016959)}, 8) AS min_payment_share_6m_cap, fd AS debt_ratio_3_24,
  round({_clip_sql('ud / 2', 0.00011443993572, 0.04283144838078)}, 8) AS revolving_share_3m_cap, fn::double AS active_months_3m,
  round({_clip_sql('gd * 8', 0.06626325, 0.77784588)}, 8) AS min_savings_6m_cap,
  CASE WHEN gd > 0.09 OR gt > 0.07 THEN '1' ELSE '0' END AS flag_degree,
  {_clip_sql('fq', 0, 17)} AS overdue_days_max_24m_cap,
  round(ud * 8)::int::varchar AS full_payment_flag_3m, ft AS debt_ratio_12_24,
  {_clip_sql('age', 22, 69)} AS age_cap, fd AS pos_share_6m, {_clip_sql('fn', 3, 24)} AS income_months_24m_cap,
  gd AS risky_contacts_max_3m, round({_clip_sql('ft * 5', 0, 0.33333333333333)}, 8) AS atm_operations_3m_cap,
  gt AS provision_cost_share_3m, CASE WHEN gq > 100 THEN 1 WHEN gq IS NOT NULL THEN 0 END::int AS savings_over_300_flag,
  ({_ratio_sql('d12', 'd24')})::double AS max_debt_12_24, ({_ratio_sql('u3m', 'p3m')})::double AS arrears_growth,
  gn::double AS service_payment_months_3m
FROM d
"""


@query("retail_panel", _RETAIL_SQL)
def retail_panel(spark, sf_dir):
    """Every month of the portfolio in one pass."""
    feat = feature_table(spark, sf_dir)
    p = retail_portfolio(spark, sf_dir)
    months = observed_months(table(spark, sf_dir, "orders"), "o_orderdate", month_key)
    arrears = (portfolio(spark, sf_dir).filter(F.col("status") != "O")
               .groupBy("month", F.col("party").cast("string").alias("party_id"))
               .agg(F.max("maturity").alias("max_days_past_due")))
    panel = retail.build(p, retail_tables(spark, feat), arrears, months[0], months[-1], unique_roles=retail.SOURCES,
                         sentinels=RETAIL_CODES)
    panel = shape.as_double(panel)
    digits = {"liability_asset_share_24m_cap": 8, "min_payment_share_6m_cap": 8,
              "revolving_share_3m_cap": 8, "min_savings_6m_cap": 8, "atm_operations_3m_cap": 8}
    return panel.withColumns({c: F.round(c, n) for c, n in digits.items()})


def business_tables(spark, sf_dir, feat):
    """Role tables of the business panel: ids are U<customer>, I<customer> and P<customer>."""
    c = F.col
    number = c("party").cast("string")
    f = feat.select("*", F.concat(F.lit("U"), number).alias("unique_id"), F.concat(F.lit("I"), number).alias("internal_id"),
                    F.concat(F.lit("P"), number).alias("party_id"))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party"),
        F.when(c("c_mktsegment").isin("BUILDING", "MACHINERY"), F.lit("6"))
        .when(c("c_mktsegment") != "FURNITURE", F.lit("1")).alias("person_type"),
        F.when(c("c_mktsegment") == "BUILDING", F.lit("COMERCIO")).when(c("c_mktsegment") == "HOUSEHOLD", F.lit("SALUD"))
        .when(c("c_mktsegment") == "MACHINERY", F.lit("AGRO")).alias("activity"))
    kinds = f.join(cust, "party")
    p = portfolio(spark, sf_dir)
    pn = c("party").cast("string")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag").distinct()
    rel = p.select("month", "party", "account").join(li, c("account") == c("l_orderkey")).select(
        "month", F.concat(F.lit("U"), pn).alias("unique_id"),
        F.concat(F.lit("U"), c("l_suppkey").cast("string")).alias("related_id"),
        F.when(c("l_returnflag") == "A", F.lit("DUENIO")).when(c("l_returnflag") == "N", F.lit("DUENIO P.N."))
        .otherwise(F.lit("OTHER")).alias("relation_type"))

    def t(key, **cols):
        return f.select("month", key, *[e.alias(n) for n, e in cols.items()])

    price, n, tax, disc, qty = c("price"), c("n_items"), c("tax"), c("discount"), c("quantity")
    return {
        "portfolio": p.select(
            "month", F.concat(F.lit("U"), pn).alias("unique_id"), F.concat(F.lit("I"), pn).alias("internal_id"),
            F.concat(F.lit("P"), pn).alias("party_id"),
            F.when(c("product") == "1-URGENT", F.lit("CCOEFT ")).when(c("product") == "2-HIGH", F.lit("PAGPYM"))
            .otherwise(F.lit("OTHER")).alias("product_code"), (c("maturity") - 2).alias("maturity_months"),
            F.when(c("status") != "P", F.lit("1 ")).otherwise(F.lit("0")).alias("valid_flag"),
            F.when(c("status") == "F", F.lit("A")).when(c("status") == "O", F.lit("AC")).otherwise(F.lit("X")).alias("status"),
            c("balance").alias("balance_local")),
        "prospects": kinds.select("month", "unique_id", "person_type"),
        "relations": rel,
        "applicants": kinds.select("month", "unique_id", (n * 7 + 15).cast("int").alias("age"), "activity", "person_type"),
        "base_vars": t("unique_id", worst_overdue=qty.cast("int"), worst_class_count=n, active_months=(n * 2).cast("int"),
                       max_advance=price, utilisation=disc * 4000),
        "material_vars": f.filter(price > 100000).select(
            "month", "unique_id", (F.floor(qty / 2)).cast("int").alias("worst_overdue"), n.alias("worst_class_count"),
            n.cast("int").alias("active_months")),
        "segment_info": t("unique_id", in_segment=F.when(n >= 3, 1).otherwise(0)),
        "transactions": t("party_id", sales_mean_6m=price, sales_max_12m=F.when(disc == 0.1, 0.0).otherwise(price * 2),
                          purchases_mean_12m=price * tax),
        "liabilities": t("unique_id", mean_balance_3m=F.when(tax == 0.08, 0.0).otherwise(qty * 1000)),
        "tenure": t("unique_id", months_registered=qty.cast("int")),
        "weighted_arrears": t("unique_id", risk_weighted_debt_12m=F.when(n == 2, 2222222222.0).otherwise(price * 3)),
        "other_debt": t("unique_id", revolving_max_3m=price),
        "experience": t("unique_id", n_employees=F.when(n == 5, -99).otherwise(n)),
        "balance_summary": t("unique_id", n_active_balances_1m=n * 3),
        "asset_liability": t("unique_id", min_liability_24m=disc * 10, max_savings_12m=price, median_savings_6m=tax,
                             max_min_savings_6m=qty * 50, mean_median_savings_6m=disc * 50, savings_asset_share_24m=tax * 400,
                             max_min_liability_12m=price, min_asset_6m=disc, max_min_asset_6m=price * 2,
                             max_min_savings_12m=price * 2),
        "deposits": t("unique_id", foreign_transfer_ticket_3m=price * 3),
        "withdrawals": t("unique_id", service_payment_ticket_3m=F.when(tax == 0.04, 44444.4444).otherwise(price)),
        "channel_payments": t("unique_id", payment_months_6m=n, payment_amount_6m=price),
        "debt_by_product": t("unique_id", worst_overdue_6m=qty * 4),
        "channel": t("unique_id", min_ticket_12m=price / 5),
        "liability_evolution": t("internal_id", mean_increase_6m=price),
        "client_evolution": t("internal_id", max_overdue_6m=qty.cast("int")),
    }


# output column -> (SQL over f0 = process month, f1 = data month, and the joined tables)
_BUSINESS_VALUES = {
    "ODEBT__revolving_max_3m": "f0.price::double", "EXPERIENCE__n_employees": "CASE WHEN f0.n_items <> 5 THEN f0.n_items END",
    "ASSETLIAB__max_min_liability_12m": "f0.price::double", "EVOLUTION__max_overdue_6m": "f0.quantity",
    "BALANCE__n_active_balances_1m": "f0.n_items * 3", "TENURE__months_registered": "f1.quantity",
    "OWNER__utilisation_owner": "(o.discount * 4000)::decimal(23,6)", "ASSETLIAB__min_liability_24m": "f0.discount * 10",
    "CHANNEL__min_ticket_12m": "f0.price::double / 5", "ASSETLIAB__savings_asset_share_24m": "f0.tax * 400",
    "ASSETLIAB__max_min_savings_6m": "f0.quantity * 50", "ASSETLIAB__mean_median_savings_6m": "f0.discount * 50",
    "ACTIVITY__decrease_over_liabilities":
        "CASE WHEN f1.n_items >= 3 AND f1.tax <> 0.08 AND f1.quantity <> 0 THEN dec.v / (f1.quantity * 1000) END",
    "OWNER__age": "f1.n_items * 7 + 15", "LIABILITY__mean_increase_6m": "f1.price::double",
    "ASSETLIAB__max_min_asset_6m": "f0.price::double * 2", "DEBT__worst_overdue_6m": "f0.quantity * 4",
    "WARREARS__risk_weighted_debt_12m": "CASE WHEN f1.n_items <> 2 THEN f1.price::double * 3 END",
    "ACTIVITY__sales_mean_over_max": "CASE WHEN f1.n_items >= 3 AND f1.discount <> 0.1 THEN 0.5::double END",
    "ASSETLIAB__max_min_savings_12m": "f0.price::double * 2", "DEPOSIT__foreign_transfer_ticket_3m": "f0.price::double * 3",
    "ACTIVITY__sales_over_purchases":
        "CASE WHEN f1.n_items >= 3 AND f1.tax <> 0 THEN f1.price::double / (f1.price::double * f1.tax) END",
    "CHANNELPAY__payment_amount_6m": "f0.price::double", "OWNER__worst_overdue_owner": "ov.worst_overdue",
}
_BUSINESS_RAW = {
    "CHANNELPAY__payment_months_6m": "f0.n_items::double",
    "WITHDRAWAL__service_payment_ticket_3m": "CASE WHEN f0.tax <> 0.04 THEN f0.price::double END",
    "OWNER__max_advance_owner": "o.price::double",
    "OWNER__active_months": "(CASE WHEN f1k.kind <> '6' THEN v1.active_months ELSE greatest(v1.active_months, ov.active_months) END)::double",
    "ASSETLIAB__max_savings_12m": "f0.price::double", "ASSETLIAB__median_savings_6m": "f0.tax",
    "ASSETLIAB__min_asset_6m": "f0.discount",
    "activity_group": "(CASE WHEN f1k.activity IS NULL OR f1k.activity IN ('COMERCIO', 'SALUD') THEN 1 ELSE 0 END)::double",
}


def _cap_sql(name, value, lo, hi):
    x = f"({value})::double"
    x = f"greatest({x}, {lo})" if lo is not None else x
    x = f"least({x}, {hi})" if hi is not None else x
    capped = f"CASE WHEN ({value}) IS NOT NULL THEN {x} END"
    if name.startswith("ACTIVITY"):  # decimal(19,8) in the panel; compared at 6 digits
        return f"round(({capped})::decimal(19,8), 6)::double"
    return f"round({capped}, 8)"


_STEP = "CASE WHEN {a} IS NOT NULL OR {b} IS NOT NULL THEN greatest(coalesce({a}, 0) - coalesce({b}, 0), 0) END"
_STEPS = [_STEP.format(a=f"b{k + 1}.v", b=f"b{k}.v") for k in (3, 2, 1)]

_BUSINESS_SQL = f"""
WITH {_FEAT_SQL},
universe AS (SELECT DISTINCT month, party FROM portfolio WHERE product IN ('1-URGENT', '2-HIGH') AND maturity - 2 > 0),
kinds AS (SELECT c_custkey AS party, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '6' WHEN c_mktsegment <> 'FURNITURE' THEN '1' END AS kind,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'COMERCIO' WHEN 'HOUSEHOLD' THEN 'SALUD' WHEN 'MACHINERY' THEN 'AGRO' END AS activity FROM customer),
vals AS (SELECT month, party, CASE WHEN price > 100000 THEN floor(quantity / 2) ELSE quantity END::int AS worst_overdue,
         CASE WHEN price > 100000 THEN n_items ELSE n_items * 2 END::int AS active_months FROM items),
owners AS (SELECT DISTINCT p.month, p.party, l.l_suppkey AS related, i.party IS NOT NULL AND k.kind = '6' AS is_company
  FROM portfolio p JOIN lineitem l ON l.l_orderkey = p.account JOIN kinds k ON k.party = p.party
  LEFT JOIN items i ON i.month = p.month AND i.party = p.party WHERE l.l_returnflag IN ('A', 'N')),
chosen AS (SELECT month, party, max('U' || (CASE WHEN coalesce(is_company, false) THEN related ELSE party END)::varchar) AS related FROM owners GROUP BY month, party),
pairs AS (SELECT DISTINCT c.month, c.party, o.related FROM chosen c JOIN owners o ON o.month = c.month AND o.party = c.party
          AND 'U' || o.related::varchar = c.related),
sums AS (SELECT month, party, sum(balance)::double AS v FROM portfolio WHERE status <> 'P' GROUP BY month, party),
steps AS (SELECT u.month, u.party, {', '.join(f'({s}) AS s{i}' for i, s in enumerate(_STEPS))} FROM universe u
  {' '.join(f"LEFT JOIN sums b{k} ON b{k}.party = u.party AND {shift_sql(f'b{k}.month', k)} = u.month" for k in range(1, 5))}),
dec AS (SELECT month, party, (coalesce(s0, 0) + coalesce(s1, 0) + coalesce(s2, 0))
          / nullif((s0 IS NOT NULL)::int + (s1 IS NOT NULL)::int + (s2 IS NOT NULL)::int, 0) AS v FROM steps)
SELECT u.month, 'U' || u.party::varchar AS unique_id, 'P' || u.party::varchar AS party_id, 'I' || u.party::varchar AS internal_id,
  {', '.join(f'{_cap_sql(c, _BUSINESS_VALUES[c], lo, hi)} AS "{c}_cap"' for c, lo, hi in business.CAPS)},
  {', '.join(f'{e} AS "{n}"' for n, e in _BUSINESS_RAW.items())}
FROM universe u
LEFT JOIN items f0 ON f0.party = u.party AND f0.month = u.month
LEFT JOIN items f1 ON f1.party = u.party AND {shift_sql('f1.month', 1)} = u.month
LEFT JOIN kinds f1k ON f1k.party = f1.party
LEFT JOIN vals v1 ON v1.party = u.party AND {shift_sql('v1.month', 1)} = u.month
LEFT JOIN pairs pr ON pr.party = u.party AND {shift_sql('pr.month', 1)} = u.month
LEFT JOIN items o ON o.party = pr.related AND o.month = pr.month
LEFT JOIN vals ov ON ov.party = pr.related AND ov.month = pr.month
LEFT JOIN dec ON dec.party = u.party AND dec.month = u.month
"""


@query("business_panel", _BUSINESS_SQL)
def business_panel(spark, sf_dir):
    """Every process month of the portfolio in one pass."""
    feat = feature_table(spark, sf_dir)
    months = observed_months(table(spark, sf_dir, "orders"), "o_orderdate", month_key)
    panel = business.build(business_tables(spark, sf_dir, feat), months[0], months[-1],
                           unique_roles=business.READERS)
    caps = [target for _, target, _, _ in business.CLIPS]
    return panel.withColumns({c: F.round(c, 6 if c.startswith("ACTIVITY") else 8) for c in caps})

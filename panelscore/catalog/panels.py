"""Rollup, enrichment, lags, densification and arrears on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscore.catalog.mapping import (CUSTOMER_MONTH_SQL, PORTFOLIO_SQL, SHIPPED_SQL, customer_month,
                                        portfolio, scratch, shift_sql, shipped_items, table)
from panelscore.catalog.registry import query
from panelscore.functions.features import decreasing_variation, max_of, trimmed_in
from panelscore.functions.months import month_key, observed_months
from panelscore.operators import arrears, densify, enrich, joins, rollup, shape
from panelscore.plans import arrears as arrears_plan
from panelscore.sources import sinks, tables

ROLLUP_SQL = f"""
WITH {PORTFOLIO_SQL}
SELECT party, month, max(account) AS account,
       coalesce(max(CASE WHEN status <> 'P' THEN 1 END), 0)::int AS is_valid,
       coalesce(max(CASE WHEN status <> 'P' THEN maturity END), 0)::int AS max_maturity,
       coalesce(sum(CASE WHEN status <> 'P' AND balance > 0 THEN balance END), 0)::double AS balance,
       coalesce(max(CASE WHEN status <> 'P' AND product = '1-URGENT' THEN 1 END), 0)::int AS flag_card,
       coalesce(max(CASE WHEN status <> 'P' AND product IN ('2-HIGH', '3-MEDIUM') THEN 1 END), 0)::int
         AS flag_consumer,
       coalesce(max(maturity), 0)::int AS max_maturity_t,
       coalesce(sum(balance), 0)::double AS balance_t,
       coalesce(max(CASE WHEN product = '1-URGENT' THEN 1 END), 0)::int AS flag_card_t,
       coalesce(max(CASE WHEN product IN ('2-HIGH', '3-MEDIUM') THEN 1 END), 0)::int AS flag_consumer_t
FROM portfolio GROUP BY party, month
"""


def rolled_up(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    return rollup.rollup_accounts(
        p, ["party", "month"], F.col("status") != "P", ids=["account"],
        max_values={"max_maturity": "maturity"}, balances={"balance": "balance"},
        flags={"flag_card": F.col("product") == "1-URGENT",
               "flag_consumer": F.col("product").isin("2-HIGH", "3-MEDIUM")}, all_suffix="_t")


@query("customer_month_rollup", ROLLUP_SQL)
def customer_month_rollup(spark, sf_dir):
    return shape.as_double(rolled_up(spark, sf_dir))


@query("portfolio_by_month", f"""
WITH {PORTFOLIO_SQL}
SELECT month, count(DISTINCT party)::bigint AS n_customers, count(*)::bigint AS n_accounts,
       round(sum(balance)::double / 1e6, 6) AS amount_millions, round(avg(balance::double), 4) AS mean,
       round(stddev_samp(balance::double), 4) AS std, min(balance)::double AS min, max(balance)::double AS max
FROM portfolio GROUP BY month
""")
def portfolio_by_month(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    counts = rollup.distinct_per_group(p, ["month"], "party").select(
        "month", F.col("n_distinct").alias("n_customers"), F.col("n_rows").alias("n_accounts"))
    amount = rollup.month_summary(p, "month", "party", "balance").select(
        "month", F.round("amount_millions", 6).alias("amount_millions"))
    d = rollup.describe_by_month(p.withColumn("balance", F.col("balance").cast("double")), "month", "balance")
    d = d.select("month", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max")
    return counts.join(amount, "month").join(d, "month")


@query("universe_canonical_id", """
WITH rows AS (
  SELECT DISTINCT c.c_name AS unique_id, o.o_orderkey AS internal_id, o.o_custkey AS party
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  WHERE trim(o.o_orderpriority) IN ('1-URGENT', '2-HIGH', '5-LOW') AND o.o_orderkey IS NOT NULL
    AND o.o_totalprice > 0)
SELECT unique_id, max(internal_id) AS internal_id, max(party) AS party FROM rows GROUP BY unique_id
""")
def universe_canonical_id(spark, sf_dir):
    o = table(spark, sf_dir, "orders").filter(
        trimmed_in("o_orderpriority", ["1-URGENT", "2-HIGH", "5-LOW"])
        & F.col("o_orderkey").isNotNull() & (F.col("o_totalprice") > 0))
    per_party = rollup.canonical_ids(o.select("o_custkey", F.col("o_orderkey").alias("internal_id")),
                                     ["o_custkey"], ["internal_id"])
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("unique_id"))
    rows = per_party.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumnRenamed("o_custkey", "party")
    return rollup.canonical_ids(rows.select("unique_id", "internal_id", "party"), ["unique_id"],
                                ["internal_id", "party"])


@query("month_shift_enrich", f"""
WITH {CUSTOMER_MONTH_SQL},
src AS (SELECT {shift_sql('month', 1)} AS month, party, balance AS prev_balance, n_accounts AS prev_accounts
        FROM customer_month)
SELECT b.month, b.party, b.balance::double AS balance, s.prev_balance::double AS prev_balance,
       s.prev_accounts::bigint AS prev_accounts
FROM customer_month b LEFT JOIN src s USING (month, party)
""")
def month_shift_enrich(spark, sf_dir):
    cm = customer_month(spark, sf_dir)
    src = enrich.FeatureSource("previous", cm, {"balance": "prev_balance", "n_accounts": "prev_accounts"},
                               "party", offset=1, unique=True)
    return shape.as_double(enrich.enrich(cm.select("month", "party", "balance"), [src]))


@query("fixed_month_read", f"""
WITH {PORTFOLIO_SQL}
SELECT DISTINCT party, {shift_sql('month', 1)} AS month, product AS "PORT__product",
       balance::double AS "PORT__balance", 'read' AS stage
FROM portfolio WHERE status <> 'P'
""")
def fixed_month_read(spark, sf_dir):
    out = enrich.fixed_months(portfolio(spark, sf_dir), 1, "party", {"product": "product", "balance": "balance"},
                              extra=F.col("status") != "P")
    out = shape.with_literals(shape.prefixed(out, "PORT", ["party", "month"]), {"stage": "read"})
    return shape.as_double(out)


@query("wide_enrichment", f"""
WITH {CUSTOMER_MONTH_SQL}, {SHIPPED_SQL},
base AS (SELECT cm.month, cm.party, cm.balance, CASE WHEN c.c_acctbal >= 0 THEN c.c_name END AS unique_id
         FROM customer_month cm JOIN customer c ON c.c_custkey = cm.party),
urgent AS (SELECT month, party, max(account) AS last_urgent FROM portfolio WHERE product = '1-URGENT'
           GROUP BY month, party),
by_name AS (SELECT p.month, c.c_name AS unique_id, c.c_nationkey AS nation, c.c_mktsegment AS segment
            FROM portfolio p JOIN customer c ON c.c_custkey = p.party GROUP BY ALL)
SELECT b.month, b.party, b.unique_id, b.balance::double AS balance, i.quantity AS quantity,
       i.price::double AS price, i1.discount AS prev_discount, u.last_urgent, n.nation, n.segment
FROM base b
LEFT JOIN items i ON i.month = b.month AND i.party = b.party
LEFT JOIN items i1 ON {shift_sql('i1.month', 1)} = b.month AND i1.party = b.party
LEFT JOIN urgent u ON u.month = b.month AND u.party = b.party
LEFT JOIN by_name n ON n.month = b.month AND n.unique_id = b.unique_id
""")
def wide_enrichment(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    p = portfolio(spark, sf_dir)
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    base = (customer_month(spark, sf_dir).join(c, F.col("party") == F.col("c_custkey"))
            .select("month", "party", known.alias("unique_id"), "balance"))
    items = shipped_items(spark, sf_dir)
    urgent = p.filter(F.col("product") == "1-URGENT").select("month", "party", "account")
    named = (p.select("month", "party").distinct().join(c, F.col("party") == F.col("c_custkey"))
             .select("month", F.col("c_name").alias("unique_id"), F.col("c_nationkey").alias("nation"),
                     F.col("c_mktsegment").alias("segment")))
    sources = [
        enrich.FeatureSource("items", items, ["quantity", "price"], "party", unique=True),
        enrich.FeatureSource("items_before", items, {"discount": "prev_discount"}, "party", 1, unique=True),
        enrich.FeatureSource("urgent", urgent, {"account": "last_urgent"}, "party"),
        enrich.FeatureSource("by_name", named, ["nation", "segment"], "unique_id", nullable_key=True)]
    return shape.as_double(enrich.enrich(base, sources, spread_by=["month", "party"]))


@query("lag_snapshots", f"""
WITH {CUSTOMER_MONTH_SQL},
lags AS (SELECT b.month, b.party, {', '.join(f's{k}.balance::double AS balance_{k}' for k in range(6))}
  FROM customer_month b
  {' '.join(f"LEFT JOIN customer_month s{k} ON s{k}.party = b.party AND {shift_sql(f's{k}.month', k)} = b.month"
            for k in range(6))})
SELECT *, greatest(balance_0, balance_1, balance_2) AS max_u3m,
       greatest(balance_3, balance_4, balance_5) AS max_p3m,
       greatest(balance_0, balance_1, balance_2, balance_3, balance_4, balance_5) AS max_u6m
FROM lags
""")
def lag_snapshots(spark, sf_dir):
    cm = customer_month(spark, sf_dir)
    out = enrich.lag_snapshots(cm.select("month", "party"), cm, "party", "balance", range(6), "balance")
    out = shape.as_double(out)
    names = [f"balance_{k}" for k in range(6)]
    return out.withColumns({"max_u3m": max_of(*names[:3]), "max_p3m": max_of(*names[3:]),
                            "max_u6m": max_of(*names)})


_PREV = "lag(g.balance) OVER (PARTITION BY g.party ORDER BY g.month)"


@query("densify_decreasing", f"""
WITH {CUSTOMER_MONTH_SQL},
months AS (SELECT DISTINCT month FROM customer_month),
ends AS (SELECT min(month) AS lo, max(month) AS hi FROM customer_month),
calendar AS (SELECT (y * 100 + m)::int AS month FROM range(1900, 2100) a(y), range(1, 13) b(m), ends
             WHERE y * 100 + m BETWEEN lo AND hi),
grid AS (SELECT p.party, c.month, cm.balance
         FROM (SELECT DISTINCT party FROM customer_month) p CROSS JOIN calendar c
         LEFT JOIN customer_month cm ON cm.party = p.party AND cm.month = c.month),
prev AS (SELECT g.*, {_PREV} AS prev FROM grid g),
var AS (SELECT party, month, CASE WHEN balance IS NULL AND prev IS NULL THEN NULL
               ELSE greatest(coalesce(prev, 0) - coalesce(balance, 0), 0) END AS decrease FROM prev)
SELECT party, count(*)::bigint AS n_months, count(decrease)::bigint AS n_known,
       sum(decrease)::double / count(decrease) AS mean_decrease
FROM var GROUP BY party
""")
def densify_decreasing(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    grid = densify.densify(p, "party", observed_months(p, "month"), "balance")
    var = densify.with_previous(grid, "party", "balance", "prev").withColumn(
        "decrease", decreasing_variation("balance", "prev"))
    return var.groupBy("party").agg(F.count("*").alias("n_months"), F.count("decrease").alias("n_known"),
                                    (F.sum("decrease").cast("double") / F.count("decrease")).alias("mean_decrease"))


@query("mean_decrease_3m", f"""
WITH {CUSTOMER_MONTH_SQL},
last4 AS (SELECT DISTINCT month, row_number() OVER (ORDER BY month) AS i
          FROM (SELECT DISTINCT month FROM customer_month ORDER BY month DESC LIMIT 4)),
grid AS (SELECT p.party, c.i, cm.balance::double AS balance
         FROM (SELECT DISTINCT party FROM customer_month JOIN last4 USING (month)) p CROSS JOIN last4 c
         LEFT JOIN customer_month cm ON cm.party = p.party AND cm.month = c.month),
prev AS (SELECT party, i, balance, lag(balance) OVER (PARTITION BY party ORDER BY i) AS prev FROM grid),
var AS (SELECT party, i, CASE WHEN balance IS NULL AND prev IS NULL THEN NULL
               ELSE greatest(coalesce(prev, 0) - coalesce(balance, 0), 0) END AS decrease FROM prev)
SELECT party, round(avg(decrease), 4) AS mean_decrease FROM var WHERE i > 1 GROUP BY party
""")
def mean_decrease_3m(spark, sf_dir):
    last4 = observed_months(portfolio(spark, sf_dir), "month")[-4:]
    p = portfolio(spark, sf_dir, last4[0], last4[-1])
    out = densify.mean_decrease(p, "party", last4, "balance", "mean_decrease")
    return out.withColumn("mean_decrease", F.round("mean_decrease", 4))


def _balance_days(spark, sf_dir):
    """Line items as account-day balances: the currency follows the return flag."""
    li = table(spark, sf_dir, "lineitem")
    currency = (F.when(F.col("l_returnflag") == "A", F.lit("0001")).when(F.col("l_returnflag") == "N", F.lit("1001"))
                .otherwise(F.lit("9999")))
    return li.select(F.col("l_orderkey").alias("account"), F.to_date("l_shipdate").alias("balance_day"),
                     currency.alias("currency"), (F.col("l_quantity") - 25).alias("debt_base"),
                     F.col("l_extendedprice").alias("price"), F.datediff("l_shipdate", F.lit("1998-01-01").cast("date"))
                     .alias("days_past_due"), "l_linestatus")


_DAILY_SQL = f"""
WITH acc AS (SELECT DISTINCT o_orderkey AS account, o_custkey AS party, o_orderstatus AS app FROM orders),
days AS (SELECT l_orderkey AS account, l_shipdate::date AS balance_day,
                CASE l_returnflag WHEN 'A' THEN '0001' WHEN 'N' THEN '1001' ELSE '9999' END AS currency,
                l_quantity - 25 AS debt, l_linestatus,
                datediff('day', DATE '1998-01-01', l_shipdate::date)::int AS dpd FROM lineitem),
rates AS (SELECT DISTINCT l_shipdate::date AS balance_day, '1001' AS currency,
                 3.0::double + day(l_shipdate) / 100.0::double AS rate
          FROM lineitem WHERE day(l_shipdate) <= 20),
card AS (SELECT d.*, a.party FROM days d JOIN acc a USING (account) WHERE a.app = 'F' AND d.l_linestatus = 'F'),
loan AS (SELECT d.*, a.party FROM days d JOIN acc a USING (account) WHERE a.app = 'O' AND d.l_linestatus = 'O'),
both_ AS (SELECT * FROM card UNION ALL SELECT * FROM loan),
local_ AS (SELECT b.*, CASE WHEN b.currency = '1001' THEN debt * rate WHEN b.currency = '0001' THEN debt END AS debt_local
           FROM both_ b LEFT JOIN rates r ON r.currency = b.currency AND r.balance_day = b.balance_day
           WHERE dpd > 0 AND b.balance_day >= DATE '1998-01-01')
SELECT (year(balance_day) * 100 + month(balance_day))::int AS month, party, max(dpd)::int AS max_days_past_due
FROM local_ WHERE debt_local > 0 GROUP BY ALL
"""


@query("daily_arrears", _DAILY_SQL)
def daily_arrears(spark, sf_dir):
    accounts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("app"))
    days = _balance_days(spark, sf_dir).withColumnRenamed("debt_base", "total_debt")
    rates = (days.filter(F.dayofmonth("balance_day") <= 20).select("balance_day").distinct()
             .withColumns({"currency": F.lit("1001"),
                           "rate": F.lit(3.0) + F.dayofmonth("balance_day") / F.lit(100.0)}))
    rows = arrears.overdue_days(days, 199801, 299912)  # to the end of the data
    priced = arrears.with_local_debt(rows, rates)
    systems = [arrears.account_month_max(priced.filter(F.col("l_linestatus") == status)).withColumn("app", F.lit(status))
               for status in ("F", "O")]
    monthly = systems[0].unionByName(systems[1])
    # an account belongs to one system: its rows in the other system's table are not its arrears
    return (monthly.join(accounts.distinct(), ["account", "app"]).groupBy("month", "party")
            .agg(F.max("days_past_due").alias("max_days_past_due")))


@query("arrears_job", f"""
WITH a AS ({_DAILY_SQL})
SELECT a.month, a.party, a.max_days_past_due, b.max_days_past_due AS before_1, c.max_days_past_due AS before_2
FROM a LEFT JOIN a b ON b.party = a.party AND {shift_sql('b.month', 1)} = a.month
       LEFT JOIN a c ON c.party = a.party AND {shift_sql('c.month', 2)} = a.month
""")
def arrears_job(spark, sf_dir):
    """Both systems to customers and months over the whole range, by a staged table, and the lags taken from it."""
    accounts = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"), F.col("o_orderstatus").alias("app"))
    days = _balance_days(spark, sf_dir).withColumnRenamed("debt_base", "total_debt")
    rates = (days.filter(F.dayofmonth("balance_day") <= 20).select("balance_day").distinct()
             .withColumns({"currency": F.lit("1001"),
                           "rate": F.lit(3.0) + F.dayofmonth("balance_day") / F.lit(100.0)}))
    systems = {status: days.filter(F.col("l_linestatus") == status) for status in ("F", "O")}
    monthly = arrears_plan.build(systems, accounts, rates, 199801, 299912)
    return enrich.lag_snapshots(monthly, monthly, "party", "max_days_past_due", [1, 2], "before")


@query("account_day_stage", f"""
WITH days AS (SELECT l_orderkey AS account, l_shipdate::date AS balance_day, l_returnflag,
                     datediff('day', DATE '1998-01-01', l_shipdate::date)::int AS dpd FROM lineitem),
rows AS (SELECT (year(balance_day) * 100 + month(balance_day))::int AS month, o.o_custkey AS party, d.account, dpd, l_returnflag
         FROM days d JOIN orders o ON o.o_orderkey = d.account WHERE dpd > 0)
SELECT month, party, max(dpd)::int AS max_days_past_due, count(*)::bigint AS n_days, count(DISTINCT account)::bigint AS n_accounts
FROM rows WHERE l_returnflag = 'A' GROUP BY month, party
""")
def account_day_stage(spark, sf_dir):
    """The account-day table written by month, read back and aggregated to customer and month."""
    accounts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("party"))
    days = _balance_days(spark, sf_dir).withColumn("debt_local", F.when(F.col("currency") == "0001", F.lit(1.0)))
    months = observed_months(table(spark, sf_dir, "lineitem"), "l_shipdate", month_key)
    rows = arrears.account_day(arrears.overdue_days(days, 199801, max(months[-1], 199801)), accounts)
    staged = sinks.stage(rows, scratch(spark, "account-day"), "month").filter(F.col("debt_local") > 0)
    per_account = staged.groupBy("month", "party", "account").agg(F.max("days_past_due").alias("dpd"), F.count("*").alias("n"))
    return per_account.groupBy("month", "party").agg(
        F.max("dpd").alias("max_days_past_due"), F.sum("n").alias("n_days"), F.count("*").alias("n_accounts"))


_SCAN = """
SELECT account, trim(status) AS status, substr(trim(product), 1, 1) AS product_code,
       CASE WHEN balance < 1000 AND trim(status) = 'P' THEN 0 ELSE balance END AS balance
FROM {source}
WHERE account IS NOT NULL AND ((trim(status) = 'F' AND trim(product) IN ('1-URGENT'))
   OR (trim(status) IN ('O', 'P') AND trim(product) IN ('2-HIGH', '5-LOW')))
"""


@query("sql_text_scan", f"WITH {PORTFOLIO_SQL} SELECT account, status, product_code, balance::double AS balance FROM ("
       + _SCAN.format(source="portfolio") + ")")
def sql_text_scan(spark, sf_dir):
    return shape.as_double(tables.select_sql(spark, portfolio(spark, sf_dir), _SCAN))


@query("top_n_per_month", f"""
WITH {PORTFOLIO_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY account) AS i FROM portfolio)
SELECT month, account, party, balance::double AS balance FROM r WHERE i <= 5
""")
def top_n_per_month(spark, sf_dir):
    p = portfolio(spark, sf_dir).select("month", "account", "party", "balance")
    top = rollup.top_n_per_group(p, ["month"], [F.col("account")], 5, ["account"])
    return shape.as_double(top)


@query("full_merge", f"""
WITH {PORTFOLIO_SQL},
a AS (SELECT party, max(balance) AS urgent_max FROM portfolio WHERE product = '1-URGENT' GROUP BY party),
b AS (SELECT party, max(balance) AS low_max FROM portfolio WHERE product = '5-LOW' GROUP BY party),
c AS (SELECT party, count(*) AS n_pending FROM portfolio WHERE status = 'P' GROUP BY party)
SELECT party, urgent_max::double AS urgent_max, low_max::double AS low_max, n_pending::bigint AS n_pending
FROM a FULL JOIN b USING (party) FULL JOIN c USING (party)
""")
def full_merge(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    a = p.filter(F.col("product") == "1-URGENT").groupBy("party").agg(F.max("balance").alias("urgent_max"))
    b = p.filter(F.col("product") == "5-LOW").groupBy("party").agg(F.max("balance").alias("low_max"))
    c = p.filter(F.col("status") == "P").groupBy("party").agg(F.count("*").alias("n_pending"))
    return shape.as_double(joins.full_merge([a, b, c], ["party"]))


_LARGEST = ("SELECT party, {0}, {1} FROM (SELECT *, row_number() OVER (PARTITION BY party ORDER BY {0} DESC NULLS LAST, "
            "{1} DESC NULLS LAST) AS i FROM {2} WHERE party IS NOT NULL) WHERE i = 1")


@query("full_merge_repeated_keys", f"""
WITH a AS (SELECT CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE o_custkey END AS party, o_orderkey,
                  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders),
b AS (SELECT CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE c_custkey // 2 END AS party, c_nationkey, c_acctbal FROM customer),
a1 AS ({_LARGEST.format('o_orderkey', 'price', 'a')}), b1 AS ({_LARGEST.format('c_nationkey', 'c_acctbal', 'b')})
SELECT party, o_orderkey, price, c_nationkey, c_acctbal FROM a1 FULL JOIN b1 USING (party)
UNION ALL SELECT party, o_orderkey, price, NULL, NULL FROM a WHERE party IS NULL
UNION ALL SELECT party, NULL, NULL, c_nationkey, c_acctbal FROM b WHERE party IS NULL
""")
def full_merge_repeated_keys(spark, sf_dir):
    """Sources that repeat their keys, or lack them: whole rows are kept, keyless rows stay apart."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    a = o.select(F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).alias("party"), "o_orderkey",
                 F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("price"))
    b = c.select(F.when(F.col("c_custkey") % 40 != 0, F.floor(F.col("c_custkey") / 2)).alias("party"), "c_nationkey",
                 "c_acctbal")
    return joins.full_merge([a, b], ["party"])

"""The test tables in their roles: portfolio, balances, rates, customer attributes.

The SQL snippets next to the functions define the same relations for the SQL counterparts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscore.functions.months import in_months, month_key
from panelscore.session import new_folder



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    """Amounts as decimals, so that sums do not depend on the order of addition."""
    return F.col(column).cast("decimal(18,2)")


def portfolio(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Account-month table: orders, optionally of a month range (filtered on the raw date)."""
    o = table(spark, sf_dir, "orders")
    if first is not None:
        o = o.filter(in_months("o_orderdate", first, last or first))
    return o.select(
        month_key("o_orderdate").alias("month"), F.col("o_custkey").alias("party"),
        F.col("o_orderkey").alias("account"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("product"), money("o_totalprice").alias("balance"),
        F.dayofmonth("o_orderdate").alias("maturity"))


PORTFOLIO_SQL = """
portfolio AS (
  SELECT (year(o_orderdate) * 100 + month(o_orderdate))::int AS month, o_custkey AS party,
         o_orderkey AS account, o_orderstatus AS status, o_orderpriority AS product,
         o_totalprice::decimal(18,2) AS balance, day(o_orderdate)::int AS maturity
  FROM orders)"""


def customer_month(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Balance and account count per customer and month."""
    return (portfolio(spark, sf_dir, first, last).groupBy("month", "party")
            .agg(F.sum("balance").alias("balance"), F.count("*").alias("n_accounts")))


CUSTOMER_MONTH_SQL = PORTFOLIO_SQL + """,
customer_month AS (
  SELECT month, party, sum(balance) AS balance, count(*) AS n_accounts
  FROM portfolio GROUP BY month, party)"""


def shipped_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items reduced to one row per order before they meet the orders: an order with very many
    items joins as one row."""
    per_order = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg(F.sum("l_quantity").alias("quantity"), F.sum(money("l_extendedprice")).alias("price"),
                      F.max("l_discount").alias("discount"), F.count("*").alias("n_items"),
                      F.max("l_tax").alias("tax")))
    return (portfolio(spark, sf_dir).join(per_order, F.col("account") == F.col("l_orderkey"))
            .groupBy("month", "party")
            .agg(F.sum("quantity").alias("quantity"), F.sum("price").alias("price"),
                 F.max("discount").alias("discount"), F.max("tax").alias("tax"),
                 F.sum("n_items").alias("n_items")))


SHIPPED_SQL = """
items AS (
  SELECT p.month, p.party, sum(l.l_quantity) AS quantity,
         sum(l.l_extendedprice::decimal(18,2)) AS price, max(l.l_discount) AS discount,
         max(l.l_tax) AS tax, count(*)::bigint AS n_items
  FROM portfolio p JOIN lineitem l ON l.l_orderkey = p.account
  GROUP BY p.month, p.party)"""


def customer_pd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a probability that covers 0, 1, nulls and the open interval."""
    c = table(spark, sf_dir, "customer")
    raw = (F.col("c_acctbal") + 1000.0) / 11000.0
    pd_ = (F.when(F.col("c_acctbal") < -900, F.lit(0.0)).when(F.col("c_acctbal") > 9900, F.lit(1.0))
           .when((F.col("c_acctbal") >= 0) & (F.col("c_acctbal") < 100), F.lit(None).cast("double"))
           .otherwise(raw * raw))
    return c.select(F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation"),
                    F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("acctbal"),
                    pd_.alias("pd"))


CUSTOMER_PD_SQL = """
customer_pd AS (
  SELECT c_custkey AS party, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS acctbal,
         CASE WHEN c_acctbal < -900 THEN 0.0::double WHEN c_acctbal > 9900 THEN 1.0::double
              WHEN c_acctbal >= 0 AND c_acctbal < 100 THEN NULL
              ELSE ((c_acctbal + 1000.0::double) / 11000.0::double)
                   * ((c_acctbal + 1000.0::double) / 11000.0::double) END AS pd
  FROM customer)"""


def shift_sql(column: str, n: int) -> str:
    """SQL for a month key moved by ``n``."""
    index = f"(({column} // 100) * 12 + {column} % 100 - 1 + ({n}))"
    return f"(({index} // 12) * 100 + {index} % 12 + 1)::int"


def log_odds_sql(p: str) -> str:
    return f"CASE WHEN {p} > 0 AND {p} < 1 THEN ln({p} / (1.0::double - {p})) END"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder."""
    return new_folder(spark, name)

"""Daily balances -> arrears per customer and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscore.functions.features import convert_currency
from panelscore.functions.months import in_months, month_key
from panelscore.operators.joins import lookup_join


def overdue_days(balances: DataFrame, first: int, last: int, *, day: str = "balance_day",
                 overdue: str = "days_past_due") -> DataFrame:
    """Days in arrears within the month range; both filters reach the scan of a plain day column."""
    return (balances.filter(F.col(overdue) > 0).filter(in_months(day, first, last))
            .withColumn("month", month_key(day)))


def with_local_debt(rows: DataFrame, rates: DataFrame, *, currency: str = "currency",
                    day: str = "balance_day", debt: str = "total_debt", local: str = "0001",
                    foreign: str = "1001") -> DataFrame:
    """Debt in local currency: ``rates`` has one row (currency, day, rate) per currency and day.

    Only foreign rows need a rate.  The others, usually most of the table, have no join key and are
    spread by their content instead of meeting in one task.  The rates are few and are broadcast
    where Spark's size check allows.
    """
    keyed = rows.withColumn("__fx", F.when(F.col(currency) == F.lit(foreign), F.col(currency)))
    lookup = rates.filter(F.col(currency) == F.lit(foreign)).select(F.col(currency).alias("__fx"), day, "rate")
    priced = lookup_join(keyed, lookup, ["__fx", day], "left")
    return priced.select(*rows.columns, convert_currency(currency, debt, "rate", local, foreign)
                         .alias("debt_local"))


def account_day(rows: DataFrame, accounts: DataFrame, *, account: str = "account", party: str = "party") -> DataFrame:
    """Account-day rows with their customers (an account may have several), for staging.

    The inner join already restricts the facts to known accounts, so no semi-join runs before it.
    """
    known = accounts.select(account, party).distinct()
    return lookup_join(rows, known, [account], "inner")


def account_month_max(rows: DataFrame, *, account: str = "account",
                      overdue: str = "days_past_due") -> DataFrame:
    """Largest arrears over days with positive local debt, per account and month."""
    return (rows.filter(F.col("debt_local") > 0).groupBy("month", account)
            .agg(F.max(overdue).alias(overdue)))


def customer_month_arrears(rows: DataFrame, accounts: DataFrame, *, account: str = "account",
                           party: str = "party", overdue: str = "days_past_due",
                           out: str = "max_days_past_due") -> DataFrame:
    """Largest arrears per customer and month.

    The days are reduced to one row per account and month before the account is matched to its
    customers: a maximum does not mind, and an account with very many days meets the join as one
    row per month.
    """
    monthly = account_month_max(rows, account=account, overdue=overdue)
    known = accounts.select(account, party).distinct()
    return (monthly.join(known, on=account, how="inner").groupBy("month", party)
            .agg(F.max(overdue).alias(out)))


def restrict_to(rows: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is known (semi-join, no fan-out)."""
    return lookup_join(rows, known.select(*on), on, "left_semi")

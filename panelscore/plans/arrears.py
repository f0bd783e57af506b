"""The arrears job: two daily balance systems to one row per customer and month."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscore.operators import arrears
from panelscore.session import new_folder
from panelscore.sources.sinks import stage

COLUMNS = ["account", "balance_day", "currency", "days_past_due", "total_debt"]


def account_days(systems: Mapping[str, DataFrame], accounts: DataFrame, rates: DataFrame, first: int,
                 last: int) -> DataFrame:
    """Days in arrears of known accounts, with their customers and the debt in local currency.

    ``systems`` has the balances of each system by its name; ``accounts`` has (account, party, app), and a balance
    counts for the accounts of its own system only.
    """
    days = None
    for app, balances in systems.items():
        part = arrears.overdue_days(balances.select(*COLUMNS), first, last).withColumn("app", F.lit(app))
        days = part if days is None else days.unionByName(part)
    known = accounts.select("account", "party", "app").distinct()
    return arrears.with_local_debt(days.join(known, ["account", "app"]), rates)


def build(systems: Mapping[str, DataFrame], accounts: DataFrame, rates: DataFrame, first: int, last: int,
          path: str | None = None, out: str = "max_days_past_due") -> DataFrame:
    """(month, party, ``out``); the account-day table is written to ``path`` by month and read back."""
    rows = account_days(systems, accounts, rates, first, last)
    staged = stage(rows, path or new_folder(rows.sparkSession, "account-days"), "month")
    # an account is reduced to one row per month before its customers are counted
    per_account = staged.filter(F.col("debt_local") > 0).groupBy("month", "party", "account").agg(
        F.max("days_past_due").alias(out))
    return per_account.groupBy("month", "party").agg(F.max(out).alias(out))

"""Retail customer panel: portfolio rollup, lagged sources, arrears snapshots, derived features.

Input tables are given by role.  A role's table holds ``month``, its key and the columns listed
below; map other column names with ``withColumnsRenamed`` before the call.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscore.functions import features
from panelscore.functions.cleaning import RETAIL_SENTINELS, null_sentinels
from panelscore.functions.months import add_months
from panelscore.operators import enrich, rollup, shape
from panelscore.operators.rollup import one_row_per_key
from panelscore.sources.tables import month_slice

# Which accounts belong to the retail portfolio, and their product groups.
PORTFOLIO_PRODUCTS = {"VP": ["TARJETA"], "ALS": ["CONSUMO", "HIPOTECARIO"]}
CARD, CONSUMER, MORTGAGE = "TARJETA", "CONSUMO", "HIPOTECARIO"
CASH_LOANS = ["04. Consumo", "14. Reprogramado Consumo", "10. Otros"]
VEHICLE_LOANS = "05. Vehicular"

# Role -> (columns, key, month offset).
SOURCES = {
    "income_months": (["income_months_24m"], "party_id", 0),
    "guarantees": (["guarantee_amount"], "party_id", 0),
    "balance_flag": (["savings_over_300_flag"], "party_id", 1),
    "demographics": (["birth_date"], "party_id", 0),
    "other_debt": (["revolving_share_3m"], "unique_id", 0),
    "debt_by_product": (["indirect_debt_3m", "debt_ratio_3_24", "debt_ratio_12_24", "active_months_3m",
                         "max_debt_12m", "max_debt_24m"], "party_id", 0),
    "experience": (["debt_evolution_3_6", "overdue_days_max_24m"], "party_id", 0),
    "card_billing": (["full_payment_flag_3m"], "unique_id", 0),
    "card_billing_txn": (["min_payment_share_6m"], "party_id", 0),
    "network_interaction": (["risky_contacts_max_3m"], "party_id", 1),
    "network_attribute": (["provision_cost_share_3m"], "party_id", 1),
    "weighted_arrears": (["weighted_debt_48m"], "party_id", 1),
    "deposits": (["atm_operations_3m"], "party_id", 0),
    "service_payments": (["service_payment_months_3m"], "party_id", 1),
    "asset_liability": (["liability_asset_share_24m", "min_savings_6m"], "party_id", 1),
    "pos": (["pos_ticket_3m"], "unique_id", 0),
    "pos_other": (["pos_share_6m"], "party_id", 0),
    "education": (["bachelor_flag", "doctor_flag", "master_flag", "degree_flag"], "party_id", 1),
}

# Caps (column, capped column, lower, upper).
CLIPS = [
    ("arrears_0", "arrears_0_cap", 1, 30),
    ("arrears_max_u6m", "arrears_max_u6m_cap", 1, 32),
    ("liability_asset_share_24m", "liability_asset_share_24m_cap", 0.00692478, 117.23953515),
    ("min_payment_share_6m", "min_payment_share_6m_cap", 0, 26.23016959),
    ("revolving_share_3m", "revolving_share_3m_cap", 0.00011443993572, 0.04283144838078),
    ("min_savings_6m", "min_savings_6m_cap", 0.06626325, 0.77784588),
    ("overdue_days_max_24m", "overdue_days_max_24m_cap", 0, 17),
    ("age", "age_cap", 22, 69),
    ("income_months_24m", "income_months_24m_cap", 3, 24),
    ("atm_operations_3m", "atm_operations_3m_cap", 0, 0.33333333333333),
    ("weighted_debt_48m", "weighted_debt_48m_cap", 0, 51084.120726),
    ("indirect_debt_3m", "indirect_debt_3m_cap", 0, 180195.45),
    ("pos_ticket_3m", "pos_ticket_3m_cap", 28.6940555566666, 262.574863266666),
    ("guarantee_amount", "guarantee_amount_cap", 0, 1760351.33),
]

# Columns that ``derived`` fills with the codes of ratios.
RATIOS = ("max_debt_12_24", "arrears_growth")

# Output contract.
KEYS = ["month", "party_id", "unique_id", "internal_id", "days_past_due", "is_valid", "balance_local",
        "flag_card", "flag_personal_card", "flag_cash", "flag_vehicle", "flag_mortgage"]
FEATURES = [
    "arrears_0_cap", "max_maturity", "arrears_max_u6m_cap", "debt_evolution_3_6", "liability_asset_share_24m_cap",
    "min_payment_share_6m_cap", "debt_ratio_3_24", "revolving_share_3m_cap", "active_months_3m",
    "min_savings_6m_cap", "flag_degree", "overdue_days_max_24m_cap", "full_payment_flag_3m", "debt_ratio_12_24",
    "age_cap", "pos_share_6m", "income_months_24m_cap", "risky_contacts_max_3m", "atm_operations_3m_cap",
    "provision_cost_share_3m", "savings_over_300_flag", "max_debt_12_24", "arrears_growth", "service_payment_months_3m"]
TYPES = {"days_past_due": "double", "is_valid": "double", "max_maturity": "double",
         "service_payment_months_3m": "double", "active_months_3m": "double", "balance_local": "decimal(33,6)"}


def accounts_of_month(portfolio: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Portfolio rows of the month (range): known account id, allowed product, text trimmed once."""
    rows = month_slice(portfolio, "month", first, last)
    text = ["party_id", "unique_id", "valid_flag", "app", "product_l0", "product_l1", "personal_card_flag"]
    rows = rows.withColumns({c: F.trim(F.col(c)) for c in text})
    return rows.filter(F.col("internal_id").isNotNull()
                       & features.any_pair("app", "product_l0", PORTFOLIO_PRODUCTS))


def customer_months(accounts: DataFrame, one_per_unique: bool = True) -> DataFrame:
    """One row per customer and month, with balances and product flags over the valid accounts.

    Customers that share a known unique id are reduced to the largest party id; customers without
    one are all kept (``one_per_unique=False`` keeps everybody).
    """
    valid = F.col("valid_flag") == "1"
    group = F.col("product_l0")
    rows = accounts.withColumn(
        "__card", F.when(group == CARD, F.col("personal_card_flag").try_cast("int")))
    out = rollup.rollup_accounts(
        rows, ["party_id", "month"], valid, ids=["internal_id", "unique_id"],
        max_values={"days_past_due": "days_past_due", "max_maturity": "maturity_months",
                    "flag_personal_card": "__card"},
        balances={"balance_local": "balance_local"},
        flags={"flag_card": group == CARD, "flag_cash": (group == CONSUMER) & F.col("product_l1").isin(CASH_LOANS),
               "flag_vehicle": (group == CONSUMER) & (F.col("product_l1") == VEHICLE_LOANS),
               "flag_mortgage": group == MORTGAGE})
    if one_per_unique:
        alone = F.when(F.col("unique_id").isNull(), F.col("party_id"))
        ordered = ["party_id", *[c for c in out.columns if c not in ("party_id", "month", "unique_id")]]
        out = one_row_per_key(out.withColumn("__alone", alone), ["month", "unique_id", "__alone"], ordered)
        out = out.drop("__alone")
    flags = ("flag_personal_card", "flag_cash", "flag_vehicle", "flag_mortgage")
    return out.withColumn("n_products", sum((F.col(f) for f in flags[1:]), F.col(flags[0])))


def feature_sources(tables: Mapping[str, DataFrame], first: int, last: int,
                    unique_roles: Collection[str] = ()) -> list[enrich.FeatureSource]:
    absent = [r for r in SOURCES if r not in tables]
    if absent:
        raise ValueError(f"missing source tables: {absent}")
    return [enrich.FeatureSource(role, tables[role], columns, key, offset, nullable_key=key == "unique_id",
                                 unique=role in unique_roles, serves=(first, last))
            for role, (columns, key, offset) in SOURCES.items()]


def derived(panel: DataFrame) -> DataFrame:
    """Features computed from several columns, on cleaned inputs."""
    panel = panel.withColumns({
        "age": features.age_at_month_end("birth_date", "month"),
        "arrears_max_u3m": features.max_of("arrears_0", "arrears_1", "arrears_2"),
        "arrears_max_p3m": features.max_of("arrears_3", "arrears_4", "arrears_5"),
        "flag_degree": features.any_flag("bachelor_flag", "doctor_flag", "master_flag", "degree_flag"),
        "max_debt_12_24": features.ratio_with_sentinels("max_debt_12m", "max_debt_24m"),
        "full_payment_flag_3m": features.flag_to_text("full_payment_flag_3m")})
    return panel.withColumns({
        "arrears_max_u6m": features.max_of("arrears_max_u3m", "arrears_max_p3m"),
        "arrears_growth": features.ratio_with_sentinels("arrears_max_u3m", "arrears_max_p3m")}).drop("birth_date")


def build(portfolio: DataFrame, tables: Mapping[str, DataFrame], arrears: DataFrame, first: int,
          last: int | None = None, one_per_unique: bool = True, unique_roles: Collection[str] = (),
          sentinels: Sequence[float] | Mapping[str, Sequence[float]] = RETAIL_SENTINELS) -> DataFrame:
    """The panel of one month or of a month range, in contract order.

    A range is built in one pass over every source, not month by month.  Tables named in
    ``unique_roles`` are known to have one row per month and key and are not de-duplicated.
    ``sentinels`` that name their columns leave all others as they are, but for the codes of ratios.
    """
    last = first if last is None else last
    base = customer_months(accounts_of_month(portfolio, first, last), one_per_unique)
    arrears = month_slice(arrears, "month", add_months(first, -5), last)
    panel = enrich.lag_snapshots(base, arrears.withColumn("party_id", F.trim(F.col("party_id"))), "party_id",
                                 "max_days_past_due", range(6), "arrears")
    panel = enrich.enrich(panel, feature_sources(tables, first, last, unique_roles), spread_by=["month", "party_id"])
    panel = derived(null_sentinels(panel, sentinels))
    if isinstance(sentinels, Mapping):
        sentinels = {**sentinels, **dict.fromkeys(RATIOS, RETAIL_SENTINELS)}
    panel = shape.as_double(null_sentinels(panel, sentinels))
    panel = features.apply_clips(panel, CLIPS)
    return shape.contract(shape.align_types(panel, TYPES), KEYS, FEATURES, missing="error")

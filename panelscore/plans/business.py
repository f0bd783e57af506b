"""Small-business panel of a month or month range: universe, owner features, activity module, feature tables.

Tables are given by role, as in the retail plan.  "Data month" is the month before the process
month; each table is read either at the data month or at the process month.  All joins are on
(month, id), so a range of process months is built in one pass over every table.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscore.functions import features
from panelscore.functions.cleaning import BUSINESS_SENTINELS, null_sentinels
from panelscore.functions.months import add_months
from panelscore.operators import densify, enrich, joins, relations, rollup, shape
from panelscore.session import new_folder
from panelscore.sources.sinks import stage
from panelscore.sources.tables import month_slice

# Products of the universe, owner relations, account states, economic activities.
PRODUCTS = [
    "CCOPCV", "CCOEFT", "CNEEFT", "PAGPYM", "CCOALP", "CCOFRO", "CCOCTB", "CCORHB", "CCORHC", "CCOCTI",
    "CPERLM", "CPEJLM", "CCOEFG", "CCOEFM", "CNEEFA", "CNEEFG", "CPEEFC", "CCOEFC", "DSGEFN",
    "TCRCJD", "TCRCJS", "TCRCND", "TCRCNS", "TCRNEJ", "TCRNEN"]
OWNER_RELATIONS = ["DUENIO", "DUENIO P.N."]
ACTIVE_STATUS = ["A", "AC", "D"]
COMPANY = "6"
ACTIVITIES = ["PESCA", "OTROS", "SERVICIOS", "ENERGIA", "CONSTRUCCION", "ADM_PUBLICA", "ACT INMOB, EMP Y DE ALQ",
              "INDUST_MANUFACT", "COMERCIO", "HOGAR", "SALUD"]

# Role -> (prefix, key, month read, columns).
DATA, PROCESS = "data", "process"
READERS = {
    "tenure": ("TENURE", "unique_id", DATA, ["months_registered"]),
    "weighted_arrears": ("WARREARS", "unique_id", DATA, ["risk_weighted_debt_12m"]),
    "other_debt": ("ODEBT", "unique_id", PROCESS, ["revolving_max_3m"]),
    "experience": ("EXPERIENCE", "unique_id", PROCESS, ["n_employees"]),
    "balance_summary": ("BALANCE", "unique_id", PROCESS, ["n_active_balances_1m"]),
    "asset_liability": ("ASSETLIAB", "unique_id", PROCESS, [
        "min_liability_24m", "max_savings_12m", "median_savings_6m", "max_min_savings_6m", "mean_median_savings_6m",
        "savings_asset_share_24m", "max_min_liability_12m", "min_asset_6m", "max_min_asset_6m", "max_min_savings_12m"]),
    "deposits": ("DEPOSIT", "unique_id", PROCESS, ["foreign_transfer_ticket_3m"]),
    "withdrawals": ("WITHDRAWAL", "unique_id", PROCESS, ["service_payment_ticket_3m"]),
    "channel_payments": ("CHANNELPAY", "unique_id", PROCESS, ["payment_months_6m", "payment_amount_6m"]),
    "debt_by_product": ("DEBT", "unique_id", PROCESS, ["worst_overdue_6m"]),
    "channel": ("CHANNEL", "unique_id", PROCESS, ["min_ticket_12m"]),
    "liability_evolution": ("LIABILITY", "internal_id", DATA, ["mean_increase_6m"]),
    "client_evolution": ("EVOLUTION", "internal_id", PROCESS, ["max_overdue_6m"]),
}

# Caps (column, lower, upper); the capped column gets the suffix _cap.
CAPS = [
    ("ODEBT__revolving_max_3m", None, 54058.633),
    ("EXPERIENCE__n_employees", 0.0, 203.0),
    ("ASSETLIAB__max_min_liability_12m", None, 88040.516),
    ("EVOLUTION__max_overdue_6m", 0.0, 59.0),
    ("BALANCE__n_active_balances_1m", None, 13.0),
    ("TENURE__months_registered", None, 396.0),
    ("OWNER__utilisation_owner", 0.0, 261.9096),
    ("ASSETLIAB__min_liability_24m", None, 0.8768666),
    ("CHANNEL__min_ticket_12m", None, 20916.992),
    ("ASSETLIAB__savings_asset_share_24m", None, 19.579279),
    ("ASSETLIAB__max_min_savings_6m", None, 4771.6816),
    ("ASSETLIAB__mean_median_savings_6m", None, 4.0419364),
    ("ACTIVITY__decrease_over_liabilities", None, 480.26755),
    ("OWNER__age", 25.0, 75.0),
    ("LIABILITY__mean_increase_6m", None, 211663.56),
    ("ASSETLIAB__max_min_asset_6m", None, 386732.84),
    ("DEBT__worst_overdue_6m", None, 469.555),
    ("WARREARS__risk_weighted_debt_12m", None, 709515.0),
    ("ACTIVITY__sales_mean_over_max", 0.0, 1.0),
    ("ASSETLIAB__max_min_savings_12m", None, 372685.25),
    ("DEPOSIT__foreign_transfer_ticket_3m", None, 379400.0),
    ("ACTIVITY__sales_over_purchases", None, 2.637802),
    ("CHANNELPAY__payment_amount_6m", None, 112905.56),
    ("OWNER__worst_overdue_owner", None, 46.0),
]
CLIPS = [(c, f"{c}_cap", lo, hi) for c, lo, hi in CAPS]

ID = ["month", "unique_id"]
KEYS = ["month", "unique_id", "party_id", "internal_id"]
RAW_FEATURES = ["CHANNELPAY__payment_months_6m", "WITHDRAWAL__service_payment_ticket_3m",
                "OWNER__max_advance_owner", "OWNER__active_months", "ASSETLIAB__max_savings_12m",
                "ASSETLIAB__median_savings_6m", "ASSETLIAB__min_asset_6m", "activity_group"]
FEATURES = [target for _, target, _, _ in CLIPS] + RAW_FEATURES


def universe(portfolio: DataFrame, first: int, last: int, products: Sequence[str] = PRODUCTS) -> DataFrame:
    """One row per month and unique id with an open account of the listed products."""
    rows = (month_slice(portfolio, "month", first, last)
            .filter(features.trimmed_in("product_code", products) & F.col("unique_id").isNotNull()
                    & F.col("internal_id").isNotNull() & (F.col("maturity_months") > 0)))
    return rollup.canonical_ids(rows, ["month", "unique_id"], ["internal_id", "party_id"])


def _once(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back, for what several joins of the panel use."""
    return stage(df, new_folder(df.sparkSession, f"business-{name}"))


def serving(table: DataFrame, first: int, last: int, lag: int = 1, key: str = "unique_id") -> DataFrame:
    """Rows that serve the process months first..last, stamped with the month they serve.

    The range filter is on the raw month column; only the needed partitions are read.
    """
    rows = month_slice(table, "month", add_months(first, -lag), add_months(last, -lag))
    return rows.withColumn("month", enrich.served_month("month", lag, key))


def own_values(base_vars: DataFrame, material_vars: DataFrame) -> DataFrame:
    """Debt variables per month and unique id, the material version where there is one.

    Values are only ever looked up by id, so ids that exist in other tables alone add nothing.
    """
    names = ["worst_overdue", "worst_class_count", "active_months"]
    base = base_vars.select(*ID, *names, "max_advance", "utilisation")
    material = material_vars.select(*ID, *[F.col(c).alias(f"{c}_material") for c in names])
    merged = joins.full_merge([base, material], ID)
    return merged.select(*ID, *[features.override(f"{c}_material", c).alias(c) for c in names],
                         "max_advance", "utilisation")


def owner_features(universe_rows: DataFrame, prospects: DataFrame, relation: DataFrame, applicants: DataFrame,
                   base_vars: DataFrame, material_vars: DataFrame) -> DataFrame:
    """Applicant attributes, the owner's debt variables and the company/owner maximum."""
    kinds = rollup.one_row_per_key(prospects, ID, ["person_type"])
    owners = (relation.filter(F.col("relation_type").isin(OWNER_RELATIONS))
              .select(*ID, "related_id").distinct())
    owners = joins.lookup_join(owners, kinds, ID, "left")
    is_company = F.coalesce(F.col("person_type") == COMPANY, F.lit(False))
    pairs = relations.chosen_owner_pairs(owners, "unique_id", "related_id", is_company, ["month"])
    values = _once(own_values(base_vars, material_vars), "values")
    owner = relations.owner_values(pairs, values, "unique_id", "related_id",
                                   ["worst_overdue", "max_advance", "utilisation", "active_months"], by=["month"])
    applicant = rollup.one_row_per_key(applicants, ID, ["age", "activity", "person_type"])
    rows = (universe_rows.select(*ID).join(applicant, ID, "left").join(owner, ID, "left")
            .join(values.select(*ID, "active_months"), ID, "left"))
    best = features.own_or_owner_max("person_type", "active_months", "active_months_owner", COMPANY)
    out = rows.select(
        *ID, F.col("age").cast("int").alias("OWNER__age"), F.col("activity").alias("OWNER__activity"),
        F.col("worst_overdue_owner").cast("int").alias("OWNER__worst_overdue_owner"),
        F.col("max_advance_owner").cast("decimal(19,8)").alias("OWNER__max_advance_owner"),
        F.col("utilisation_owner").cast("decimal(23,6)").alias("OWNER__utilisation_owner"),
        best.cast("int").alias("OWNER__active_months"))
    return null_sentinels(out, BUSINESS_SENTINELS, [c for c in out.columns if c not in ID])


def activity_features(universe_rows: DataFrame, segment_info: DataFrame, transactions: DataFrame, portfolio: DataFrame,
                      liabilities: DataFrame, first: int, last: int) -> DataFrame:
    """Sales ratios and debt decrease over liabilities; null outside the active segment.

    Every table but the portfolio is already stamped with the month it serves.
    """
    party = ["month", "party_id"]
    members = segment_info.filter(F.col("in_segment") == 1)
    sales = rollup.one_row_per_key(transactions, party, ["sales_mean_6m", "sales_max_12m", "purchases_mean_12m"])
    debts = (month_slice(portfolio, "month", add_months(first, -4), add_months(last, -1))
             .filter((F.trim(F.col("valid_flag")) == "1") & F.col("status").isin(ACTIVE_STATUS)))
    means = rollup.one_row_per_key(liabilities, ID, ["mean_balance_3m"])
    rows = enrich.membership(universe_rows.select(*ID, "party_id"), members, ID)
    rows = rows.join(means, ID, "left")
    rows = joins.left_lookup(rows, sales, party, ["party_id"], ["month", "unique_id"])
    people = rows.select(*party).filter(F.col("party_id").isNotNull()).distinct()
    decrease = densify.mean_decrease_before(people, debts, "party_id", "balance_local", "mean_decrease")
    rows = joins.left_lookup(rows, decrease, party, ["party_id"], ["month", "unique_id"])

    def inside(numerator: str, denominator: str):
        ratio = features.plain_ratio(F.col(numerator).cast("double"), F.col(denominator).cast("double"))
        return enrich.only_members(ratio).try_cast("decimal(19,8)")

    return rows.select(
        *ID, inside("sales_mean_6m", "sales_max_12m").alias("ACTIVITY__sales_mean_over_max"),
        inside("mean_decrease", "mean_balance_3m").alias("ACTIVITY__decrease_over_liabilities"),
        inside("sales_mean_6m", "purchases_mean_12m").alias("ACTIVITY__sales_over_purchases"))


def read_source(role: str, table: DataFrame, first: int, last: int, unique: bool = False) -> enrich.FeatureSource:
    prefix, key, which, columns = READERS[role]
    rows = serving(table, first, last, 0 if which == PROCESS else 1, key)
    return enrich.FeatureSource(role, rows, {c: f"{prefix}__{c}" for c in columns}, key, unique=unique)


def build(tables: Mapping[str, DataFrame], first: int, last: int | None = None,
          features_wanted: Sequence[str] = FEATURES, products: Sequence[str] = PRODUCTS,
          unique_roles: Collection[str] = ()) -> DataFrame:
    """The panel of the process months, keys and features in contract order, features as double.

    Feature tables named in ``unique_roles`` have one row per month and key already.
    """
    last = first if last is None else last
    customers = _once(universe(tables["portfolio"], first, last, products), "universe")

    def at_data_month(role: str, key: str = "unique_id") -> DataFrame:
        return serving(tables[role], first, last, 1, key)

    owner = owner_features(customers, at_data_month("prospects"), at_data_month("relations"),
                           at_data_month("applicants"), at_data_month("base_vars"), at_data_month("material_vars"))
    activity = activity_features(customers, at_data_month("segment_info"), at_data_month("transactions", "party_id"),
                                 tables["portfolio"], at_data_month("liabilities"), first, last)
    sources = [enrich.FeatureSource(n, _once(df, n), [c for c in df.columns if c not in ID], "unique_id", unique=True)
               for n, df in (("owner", owner), ("activity", activity))]
    sources += [read_source(role, tables[role], first, last, role in unique_roles) for role in READERS]
    panel = enrich.enrich(customers, sources)
    panel = null_sentinels(panel, BUSINESS_SENTINELS, [c for c in panel.columns if c not in KEYS])
    panel = features.apply_clips(panel, CLIPS).withColumn(
        "activity_group", features.in_category("OWNER__activity", ACTIVITIES))
    out = shape.contract(panel, KEYS, features_wanted)
    return shape.to_double(out, keep=[*KEYS, "OWNER__activity"])

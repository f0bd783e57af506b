"""Related parties, materiality, membership and related joins on the test tables.

The relation table comes from the facts: a customer is related to every supplier it bought from.
Ids share one space, suppliers being negative.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscore.catalog.mapping import PORTFOLIO_SQL, money, portfolio, table
from panelscore.catalog.registry import query
from panelscore.functions import features
from panelscore.operators import enrich, joins, relations, shape

RELATION_SQL = """
relation AS (
  SELECT DISTINCT o.o_custkey AS party, CASE WHEN l.l_suppkey = o.o_custkey THEN o.o_custkey ELSE -1 - l.l_suppkey END AS related
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_returnflag IN ('A', 'R')),
typed AS (SELECT r.party, r.related, CASE WHEN c.c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '6'
                 WHEN c.c_mktsegment = 'FURNITURE' THEN NULL ELSE '1' END AS party_type
          FROM relation r JOIN customer c ON c.c_custkey = r.party),
chosen AS (SELECT party, max(CASE WHEN coalesce(party_type, '') = '6' THEN related ELSE party END) AS related
           FROM typed GROUP BY party)"""


def party_types(spark, sf_dir):
    seg = F.col("c_mktsegment")
    kind = (F.when(seg.isin("BUILDING", "MACHINERY"), F.lit("6")).when(seg == "FURNITURE", F.lit(None).cast("string"))
            .otherwise(F.lit("1")))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), kind.alias("party_type"))


def relation(spark, sf_dir):
    """(party, related, party_type), reduced to distinct (order, supplier) before the join."""
    li = (table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
          .select("l_orderkey", "l_suppkey").distinct())
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("party"))
    related = F.when(F.col("l_suppkey") == F.col("party"), F.col("party")).otherwise(-1 - F.col("l_suppkey"))
    pairs = (joins.lookup_join(li, o, ["l_orderkey"], "inner")
             .select("party", related.alias("related")).distinct())
    return joins.lookup_join(pairs, party_types(spark, sf_dir), ["party"], "inner")


def _is_company():
    return F.coalesce(F.col("party_type") == "6", F.lit(False))


@query("owner_flags", f"""
WITH {RELATION_SQL}
SELECT t.party, t.related, (c.party IS NOT NULL)::int AS is_owner
FROM typed t LEFT JOIN chosen c ON c.party = t.party AND c.related = t.related
""")
def owner_flags(spark, sf_dir):
    rel = relation(spark, sf_dir)
    chosen = relations.canonical_owner(rel, "party", "related", _is_company())
    return relations.flag_chosen(rel.select("party", "related"), chosen, ["party", "related"], "is_owner")


@query("owner_features", f"""
WITH {RELATION_SQL},
pairs AS (SELECT t.party, t.related FROM typed t JOIN chosen c ON c.party = t.party AND c.related = t.related),
vals AS (SELECT c_custkey AS party, c_acctbal AS acctbal, c_nationkey AS nation FROM customer
         UNION ALL SELECT -1 - s_suppkey, s_acctbal, s_nationkey FROM supplier)
SELECT p.party, v.acctbal AS acctbal_owner, v.nation AS nation_owner FROM pairs p LEFT JOIN vals v ON v.party = p.related
""")
def owner_features(spark, sf_dir):
    pairs = relations.chosen_owner_pairs(relation(spark, sf_dir), "party", "related", _is_company())
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("acctbal"),
                                                F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select((-1 - F.col("s_suppkey")).alias("party"),
                                                F.col("s_acctbal").alias("acctbal"),
                                                F.col("s_nationkey").alias("nation"))
    return relations.owner_values(pairs, c.unionByName(s), "party", "related", ["acctbal", "nation"])


@query("materiality_override", f"""
WITH {PORTFOLIO_SQL},
base AS (SELECT party, max(maturity) AS dpd, count(*) AS n FROM portfolio WHERE product <> '5-LOW' GROUP BY party),
material AS (SELECT party, max(maturity) AS dpd_100, count(*) AS n_100 FROM portfolio
             WHERE balance > 400000 GROUP BY party),
ship AS (SELECT o.o_custkey AS party, max(l.l_quantity) AS qty FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
         WHERE l.l_returnflag = 'R' GROUP BY party)
SELECT party, CASE WHEN dpd_100 IS NULL THEN dpd ELSE dpd_100 END::int AS dpd,
       CASE WHEN n_100 IS NULL THEN n ELSE n_100 END::bigint AS n, qty
FROM base FULL JOIN material USING (party) FULL JOIN ship USING (party)
""")
def materiality_override(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    base = p.filter(F.col("product") != "5-LOW").groupBy("party").agg(F.max("maturity").alias("dpd"),
                                                                      F.count("*").alias("n"))
    material = p.filter(F.col("balance") > 400000).groupBy("party").agg(F.max("maturity").alias("dpd_100"),
                                                                        F.count("*").alias("n_100"))
    per_order = (table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").groupBy("l_orderkey")
                 .agg(F.max("l_quantity").alias("qty")))
    ship = (p.select("party", "account").join(per_order, F.col("account") == F.col("l_orderkey"))
            .groupBy("party").agg(F.max("qty").alias("qty")))
    merged = joins.full_merge([base, material, ship], ["party"])
    return merged.select("party", features.override("dpd_100", "dpd").alias("dpd"),
                         features.override("n_100", "n").alias("n"), "qty")


@query("entity_switch_max", """
WITH v AS (SELECT c.c_custkey AS party, c.c_acctbal AS own, s.s_acctbal AS owner,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN '6' WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE '1' END AS kind
  FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey)
SELECT party, CASE WHEN kind <> '6' THEN own ELSE greatest(own, owner) END AS value,
       greatest(own, owner) AS text_max
FROM v
""")
def entity_switch_max(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"), F.col("c_acctbal").alias("own"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("party"), F.col("s_acctbal").alias("owner"))
    v = c.join(s, "party", "left").join(party_types(spark, sf_dir), "party")
    text = F.coalesce(F.col("owner").cast("string"), F.lit("NULL"))
    return v.select("party", features.own_or_owner_max("party_type", "own", "owner").alias("value"),
                    features.text_max("own", text, F.lit("")).alias("text_max"))


@query("segment_membership", f"""
WITH {PORTFOLIO_SQL},
seg AS (SELECT DISTINCT party FROM portfolio WHERE product = '1-URGENT' AND status = 'F'),
amounts AS (SELECT party, sum(CASE WHEN status = 'O' THEN balance END) AS open_amount,
                   sum(CASE WHEN status = 'P' THEN balance ELSE 0 END) AS pending_amount
            FROM portfolio GROUP BY party)
SELECT c.c_custkey AS party, (s.party IS NOT NULL)::int AS is_member,
  CASE WHEN s.party IS NOT NULL AND pending_amount <> 0 THEN round(open_amount::double / pending_amount::double, 6) END AS ratio
FROM customer c LEFT JOIN seg s ON s.party = c.c_custkey LEFT JOIN amounts a ON a.party = c.c_custkey
""")
def segment_membership(spark, sf_dir):
    p = portfolio(spark, sf_dir)
    seg = p.filter((F.col("product") == "1-URGENT") & (F.col("status") == "F"))
    amounts = p.groupBy("party").agg(
        F.sum(F.when(F.col("status") == "O", F.col("balance"))).cast("double").alias("open_amount"),
        F.sum(F.when(F.col("status") == "P", F.col("balance")).otherwise(0)).cast("double").alias("pending_amount"))
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("party"))
    flagged = enrich.membership(base, seg, ["party"]).join(amounts, "party", "left")
    ratio = features.plain_ratio("open_amount", "pending_amount")
    return flagged.select("party", "is_member", F.round(enrich.only_members(ratio), 6).alias("ratio"))


@query("known_accounts", """
SELECT l_orderkey, l_linenumber, l_extendedprice::decimal(18,2)::double AS price FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
""")
def known_accounts(spark, sf_dir):
    known = (table(spark, sf_dir, "orders")
             .filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))
             .select(F.col("o_orderkey").alias("l_orderkey")))
    from panelscore.operators.arrears import restrict_to
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", money("l_extendedprice").alias("price"))
    return shape.as_double(restrict_to(rows, known, ["l_orderkey"]))

"""Comparison, certification and lag tracing: orders against a perturbed copy of themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelscore.catalog.mapping import (CUSTOMER_MONTH_SQL, PORTFOLIO_SQL, customer_month, portfolio, shift_sql,
                                        table)
from panelscore.catalog.registry import query
from panelscore.functions.months import month_key, add_months
from panelscore.operators import certify, compare, trace

_NEW = {
    "o_totalprice": "CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 0.0000001 "
                    "WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN o_totalprice + 1 "
                    "WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END",
    "o_orderstatus": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_totalprice > 490000 THEN 'X' ELSE o_orderstatus END",
}

_SIDES_SQL = f"""
base AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
         WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice < 3000)),
target AS (SELECT o_orderkey, o_custkey, {_NEW['o_totalprice']} AS o_totalprice, {_NEW['o_orderstatus']} AS o_orderstatus,
                  o_orderpriority FROM orders WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_totalprice > 497000))"""


def _sides(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                              "o_orderpriority")
    unspecified = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    base = o.filter(~(unspecified & (F.col("o_totalprice") < 3000)))
    target = (o.withColumns({c: F.expr(e) for c, e in _NEW.items()})
              .filter(~(unspecified & (F.coalesce(F.col("o_totalprice"), F.lit(0.0)) > 497000))))
    return base, target


_COLS = ["o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]


def _eq(c: str, tol: float = 1e-6) -> str:
    b, t = f"b.{c}", f"t.{c}"
    close = f"abs({b} - {t}) <= {tol}" if c in ("o_custkey", "o_totalprice") else f"{b} = {t}"
    return f"CASE WHEN ({b} IS NULL AND {t} IS NULL) OR coalesce({close}, false) THEN 1 ELSE 0 END"


def _paired_sql(tol: float = 1e-6) -> str:
    return (f"paired AS (SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, b.o_orderkey IS NOT NULL AS in_b, "
            f"t.o_orderkey IS NOT NULL AS in_t, b.o_totalprice - t.o_totalprice AS diff, "
            + ", ".join(f"{_eq(c, tol)} AS {c}" for c in _COLS)
            + " FROM base b FULL JOIN target t ON b.o_orderkey = t.o_orderkey)")


def _summary_sql(where: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS variable, (count(*) - sum({c}))::bigint AS count_0, sum({c})::bigint AS count_1, "
        f"round(100.0::double * sum({c}) / count(*), 6) AS match_pct, "
        f"(round(100.0::double * sum({c}) / count(*), 6) >= 99.0)::int AS passed FROM paired {where}" for c in _COLS)


@query("compare_rows", f"""
WITH {_SIDES_SQL}, {_paired_sql()}
SELECT o_orderkey, in_b::bigint AS n_base, in_t::bigint AS n_target, round(diff, 4) AS o_totalprice_diff,
       o_custkey::int AS o_custkey_eq, o_totalprice::int AS o_totalprice_eq, o_orderstatus::int AS o_orderstatus_eq,
       o_orderpriority::int AS o_orderpriority_eq FROM paired
""")
def compare_rows(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    rows = compare.compare_rows(base, target, ["o_orderkey"], _COLS)
    return rows.select("o_orderkey", "n_base", "n_target", F.round("o_totalprice_diff", 4).alias("o_totalprice_diff"),
                       *[f"{c}_eq" for c in _COLS])


@query("compare_tables", f"WITH {_SIDES_SQL}, {_paired_sql()}\n{_summary_sql()}")
def compare_tables(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    _, summary, _ = compare.compare_tables(base, target, ["o_orderkey"], _COLS, require_equal_counts=False)
    return summary


@query("compare_variables", f"WITH {_SIDES_SQL}, {_paired_sql()}\n{_summary_sql('WHERE in_b AND in_t')}")
def compare_variables(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    return compare.compare_common(base, target, ["o_orderkey"])


@query("equality_report", f"""
WITH {_SIDES_SQL}
SELECT count(*)::bigint AS total, count_if(b.o_totalprice IS NOT DISTINCT FROM t.o_totalprice)::bigint AS price_ok,
  count_if(b.o_totalprice IS DISTINCT FROM t.o_totalprice)::bigint AS price_no,
  count_if(b.o_orderstatus IS NOT DISTINCT FROM t.o_orderstatus)::bigint AS status_ok,
  count_if(b.o_orderstatus IS DISTINCT FROM t.o_orderstatus)::bigint AS status_no
FROM base b JOIN target t ON b.o_orderkey = t.o_orderkey
""")
def equality_report(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    both = compare.paired(base, target, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])
    both = both.filter((F.col("n_base") > 0) & (F.col("n_target") > 0))
    return compare.equality_report(both, [("price", "o_totalprice_base", "o_totalprice_target"),
                                          ("status", "o_orderstatus_base", "o_orderstatus_target")])


@query("differing_rows", f"""
WITH {_SIDES_SQL}
SELECT b.o_orderkey, b.o_orderstatus AS o_orderstatus_base, t.o_orderstatus AS o_orderstatus_target
FROM base b JOIN target t ON b.o_orderkey = t.o_orderkey
WHERE b.o_totalprice IS DISTINCT FROM t.o_totalprice OR b.o_orderstatus IS DISTINCT FROM t.o_orderstatus
""")
def differing_rows(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    both = compare.paired(base, target, ["o_orderkey"], ["o_totalprice", "o_orderstatus"])
    both = both.filter((F.col("n_base") > 0) & (F.col("n_target") > 0))
    bad = compare.differing_rows(both, [("price", "o_totalprice_base", "o_totalprice_target"),
                                        ("status", "o_orderstatus_base", "o_orderstatus_target")])
    return bad.select("o_orderkey", "o_orderstatus_base", "o_orderstatus_target")


@query("key_overlap", f"""
WITH {_SIDES_SQL}, {_paired_sql()}
SELECT count_if(in_b AND in_t)::bigint AS n_both, count_if(in_b AND NOT in_t)::bigint AS only_base,
       count_if(in_t AND NOT in_b)::bigint AS only_target, 0::bigint AS n_repeated FROM paired
""")
def key_overlap(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    return compare.key_overlap(compare.paired(base, target, ["o_orderkey"], []))


@query("compare_null_keys", """
WITH b AS (SELECT CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey END AS k, c_acctbal AS v FROM customer),
t AS (SELECT k, CASE WHEN k % 7 = 0 THEN v + 1 ELSE v END AS v FROM b),
known AS (SELECT b.k FROM b JOIN t ON b.k = t.k),
alone AS (SELECT v, count(*) AS n FROM b WHERE k IS NULL GROUP BY v)
SELECT (SELECT count(*) FROM known)::bigint AS n_both, (SELECT count(*) FROM alone)::bigint AS only_base,
       (SELECT count(*) FROM alone)::bigint AS only_target,
       (SELECT 2 * count_if(n > 1) FROM alone)::bigint AS n_repeated
""")
def compare_null_keys(spark, sf_dir):
    """Rows without key match nothing, on either side."""
    base = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 20 != 0, F.col("c_custkey")).alias("k"), F.col("c_acctbal").alias("v"))
    target = base.withColumn("v", F.when(F.col("k") % 7 == 0, F.col("v") + 1).otherwise(F.col("v")))
    rows = compare.compare_rows(base, target, ["k"], ["v"])
    return compare.key_overlap(rows)


def _only(table: str, side: str, columns: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", 'only_{side}' AS difference, {repr(t) if side == 'base' else 'NULL'} AS base_value, "
        f"{repr(t) if side == 'target' else 'NULL'} AS target_value, count({c})::bigint AS n_known FROM {table}"
        for c, t in columns.items())


@query("schema_diff", _only("customer", "base", {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                                                 "c_acctbal": "double", "c_mktsegment": "string"}) + "\nUNION ALL "
       + _only("supplier", "target", {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int",
                                      "s_acctbal": "double"}))
def schema_diff(spark, sf_dir):
    """Columns that differ, with the number of rows that hold a value there."""
    base, target = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    known = [df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "n_known")
             for df in (base, target)]
    return compare.compare_schemas(base.schema, target.schema, spark).join(known[0].unionByName(known[1]), "column", "left")


@query("null_rate_diff", """
WITH b AS (SELECT 100.0::double * count_if(l_discount > 0.08) / count(*) AS d, 100.0::double * count_if(l_tax = 0) / count(*) AS t
           FROM lineitem),
t AS (SELECT 100.0::double * count_if(l_discount > 0.05) / count(*) AS d, 100.0::double * count_if(l_tax = 0) / count(*) AS t FROM lineitem),
u AS (SELECT 'discount' AS variable, b.d AS base_pct, t.d AS target_pct FROM b, t
      UNION ALL SELECT 'tax', b.t, t.t FROM b, t)
SELECT variable, round(base_pct, 6) AS base_pct, round(target_pct, 6) AS target_pct,
       (abs(base_pct - target_pct) > 1.0)::int AS differs FROM u
""")
def null_rate_diff(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("tax")
    base = li.select(F.when(F.col("l_discount") <= 0.08, F.col("l_discount")).alias("discount"), tax)
    target = li.select(F.when(F.col("l_discount") <= 0.05, F.col("l_discount")).alias("discount"), tax)
    out = compare.compare_null_rates(base, target, ["discount", "tax"])
    return out.withColumns({c: F.round(c, 6) for c in ("base_pct", "target_pct")})


@query("score_diff", f"""
WITH {_SIDES_SQL}, j AS (SELECT abs(b.o_totalprice - t.o_totalprice) AS gap FROM base b JOIN target t ON b.o_orderkey = t.o_orderkey)
SELECT count(*)::bigint AS n, round(avg(gap), 6) AS mean_diff, round(max(gap), 6) AS max_diff,
       count_if(gap <= 1e-6)::bigint AS matches_1, count_if(gap <= 1e-4)::bigint AS matches_2 FROM j
""")
def score_diff(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    out = compare.score_differences(base, target, ["o_orderkey"], "o_totalprice")
    return out.withColumns({c: F.round(c, 6) for c in ("mean_diff", "max_diff")})


@query("score_summary", f"""
WITH {_SIDES_SQL}
SELECT count(*)::bigint AS total, count_if(o_totalprice IS NULL)::bigint AS n_null, round(min(o_totalprice), 4) AS min,
       round(max(o_totalprice), 4) AS max, round(avg(o_totalprice), 4) AS mean FROM target
""")
def score_summary(spark, sf_dir):
    out = compare.score_summary(_sides(spark, sf_dir)[1], "o_totalprice")
    return out.withColumns({c: F.round(c, 4) for c in ("min", "max", "mean")})


@query("average_diff", f"""
WITH {_SIDES_SQL}
SELECT 'o_totalprice' AS variable, round((SELECT avg(o_totalprice) FROM base), 4) AS avg_base,
       round((SELECT avg(o_totalprice) FROM target), 4) AS avg_target
UNION ALL SELECT 'o_custkey', round((SELECT avg(o_custkey) FROM base), 4), round((SELECT avg(o_custkey) FROM target), 4)
""")
def average_diff(spark, sf_dir):
    out = compare.compare_averages(*_sides(spark, sf_dir), ["o_totalprice", "o_custkey"])
    return out.withColumns({c: F.round(c, 4) for c in ("avg_base", "avg_target")})


_CERT = ["o_custkey", "o_totalprice", "o_orderstatus"]


def _light(v: str, green: float, yellow: float | None = None) -> str:
    mid = f" WHEN {v} >= {yellow} THEN 'yellow'" if yellow is not None else ""
    return f"CASE WHEN {v} >= {green} THEN 'green'{mid} ELSE 'red' END"


def _cert_sql(segment: str, group: str, source: str) -> str:
    cols = [c for c in _CERT if not (c == "o_orderpriority")]
    mean = "(" + " + ".join(f"100.0::double * sum({c}) / count(*)" for c in cols) + f") / {len(cols)}.0::double"
    return f"""SELECT {segment} AS segment,
  100.0::double * least(count_if(in_b), count_if(in_t)) / greatest(count_if(in_b), count_if(in_t)) AS records,
  100.0::double AS schema, {mean} AS data_match,
  CASE WHEN 100.0::double * sum(o_totalprice) / count(*) >= 99 THEN 100.0::double ELSE 0 END AS critical_fields
  FROM {source} {group}"""


_CERT_TAIL = "\nUNION ALL ".join(
    f"SELECT segment, '{k}' AS \"check\", round({k}, 6) AS value, {_light(k, g, y)} AS light FROM c"
    for k, g, y in (("records", 99, None), ("schema", 100, None), ("data_match", 99, 96), ("critical_fields", 100, None)))

_SEG_PAIRED = _paired_sql(0.05).replace("paired AS (SELECT", "seg_paired AS (SELECT coalesce(b.o_orderpriority, t.o_orderpriority) AS seg,").replace(
    "ON b.o_orderkey = t.o_orderkey)", "ON b.o_orderkey = t.o_orderkey AND b.o_orderpriority = t.o_orderpriority)")


@query("certification", f"""
WITH {_SIDES_SQL}, {_paired_sql(0.05)}, c AS ({_cert_sql("'global'", '', 'paired')})
{_CERT_TAIL}
""")
def certification(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    out = certify.certify(base, target, ["o_orderkey"], _CERT, critical=["o_totalprice"])
    return out.withColumn("value", F.round("value", 6))


@query("certification_segments", f"""
WITH {_SIDES_SQL}, {_paired_sql(0.05)}, {_SEG_PAIRED},
c AS ({_cert_sql("'global'", '', 'paired')} UNION ALL {_cert_sql('seg', 'GROUP BY seg', 'seg_paired')})
{_CERT_TAIL}
""")
def certification_segments(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    out = certify.certify_segments(base, target, ["o_orderkey"], _CERT, "o_orderpriority", critical=["o_totalprice"])
    return out.withColumn("value", F.round("value", 6))


@query("certification_status", f"""
WITH {_SIDES_SQL}, {_paired_sql(0.05)}, {_SEG_PAIRED},
c AS ({_cert_sql("'global'", '', 'paired')} UNION ALL {_cert_sql('seg', 'GROUP BY seg', 'seg_paired')}),
r AS ({_CERT_TAIL})
SELECT segment, CASE WHEN count_if(light = 'red') = 0 THEN 'certified' ELSE 'rejected' END AS status,
  count_if(light = 'green')::bigint AS passed, count_if(light = 'red')::bigint AS failed,
  count_if(light = 'yellow')::bigint AS warnings FROM r GROUP BY segment
""")
def certification_status(spark, sf_dir):
    base, target = _sides(spark, sf_dir)
    return certify.overall(certify.certify_segments(base, target, ["o_orderkey"], _CERT, "o_orderpriority",
                                                    critical=["o_totalprice"]))


_PROCESS = 199901


@query("lag_trace", f"""
WITH {CUSTOMER_MONTH_SQL},
tgt AS (SELECT {shift_sql('month', 1)} AS month, party, CASE WHEN n_accounts > 1 THEN 0 ELSE balance END AS v FROM customer_month),
two AS (SELECT party, max(CASE WHEN month = {add_months(_PROCESS, -1)} THEN balance END) AS a,
               max(CASE WHEN month = {_PROCESS} THEN balance END) AS b FROM customer_month GROUP BY party)
SELECT CASE WHEN v = a THEN 'previous' WHEN v = b THEN 'process' ELSE 'none' END AS verdict, count(*)::bigint AS n
FROM two JOIN tgt ON tgt.party = two.party AND tgt.month = {_PROCESS}
WHERE a IS NOT NULL AND b IS NOT NULL AND a <> b GROUP BY verdict
""")
def lag_trace(spark, sf_dir):
    """The target takes the balance of the month before (and 0 for some customers)."""
    from panelscore.functions.months import shift_month
    cm = customer_month(spark, sf_dir, add_months(_PROCESS, -1), _PROCESS)
    target = cm.select(shift_month("month", 1).alias("month"), "party",
                       F.when(F.col("n_accounts") > 1, F.lit(0)).otherwise(F.col("balance")).alias("v"))
    return trace.lag_trace(cm, target, "party", "balance", "v", add_months(_PROCESS, -1), _PROCESS)


_EVIDENCE = [add_months(_PROCESS, -2), add_months(_PROCESS, -1), _PROCESS]


def _evidence_sql(name: str, source: str, target: str) -> str:
    a, b, c = (f"max(CASE WHEN month = {m} THEN {source} END)" for m in _EVIDENCE)
    t = f"max(CASE WHEN month = {target} THEN {source} END)"
    return f"""SELECT '{name}' AS variable, count_if(v) AS voters, count_if(v AND a = t) AS v1, count_if(v AND b = t) AS v2,
      count_if(v AND c = t) AS v3 FROM (SELECT *, a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND (a <> b OR a <> c) AS v
      FROM (SELECT party, {a} AS a, {b} AS b, {c} AS c, {t} AS t FROM known GROUP BY party) WHERE party IN (SELECT party FROM tgt))"""


@query("lag_evidence", f"""
WITH {CUSTOMER_MONTH_SQL},
known AS (SELECT month, party, balance, n_accounts, 1 AS one FROM customer_month WHERE month IN {tuple(_EVIDENCE)}),
tgt AS (SELECT party FROM known WHERE month IN {tuple(_EVIDENCE[1:])}),
w AS ({_evidence_sql("accounts", "n_accounts", str(_EVIDENCE[2]))} UNION ALL {_evidence_sql("balance", "balance", str(_EVIDENCE[1]))}
      UNION ALL {_evidence_sql("constant", "one", str(_EVIDENCE[2]))}),
l AS (SELECT *, greatest(v1, v2, v3) AS most, unnest([{', '.join(f"{{'m': {m}, 'v': v{i + 1}}}" for i, m in enumerate(_EVIDENCE))}]) AS e FROM w)
SELECT variable, e.m::int AS candidate, voters::bigint AS voters, e.v::bigint AS votes,
       CASE WHEN voters > 0 THEN e.v::double / voters END AS share,
       CASE WHEN voters = 0 THEN 'ambiguous' WHEN most = 0 THEN 'none' WHEN (v1 = most)::int + (v2 = most)::int + (v3 = most)::int > 1
            THEN 'ambiguous' WHEN v1 = most THEN '{_EVIDENCE[0]}' WHEN v2 = most THEN '{_EVIDENCE[1]}' ELSE '{_EVIDENCE[2]}' END AS verdict
FROM l
""")
def lag_evidence(spark, sf_dir):
    """Three variables of a target: one of the month before, one of the same month, and one that never changes."""
    cm = customer_month(spark, sf_dir, _EVIDENCE[0], _PROCESS).select(
        "month", "party", "balance", "n_accounts", F.lit(1).alias("one"))
    m = F.col("month")
    target = cm.where(m >= _EVIDENCE[1]).groupBy("party").agg(
        F.max(F.when(m == _EVIDENCE[1], F.col("balance"))).alias("t_balance"),
        F.max(F.when(m == _PROCESS, F.col("n_accounts"))).alias("t_accounts"),
        F.max(F.when(m == _PROCESS, F.col("one"))).alias("t_one")).withColumn("month", F.lit(_PROCESS))
    names = {"balance": ("balance", "t_balance"), "accounts": ("n_accounts", "t_accounts"), "constant": ("one", "t_one")}
    return trace.lag_evidence(cm, target, "party", names, _EVIDENCE, _PROCESS)


@query("differing_parts", """
WITH t AS (SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1995 AND o_orderkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
                  o_orderdate FROM orders)
SELECT o.o_orderkey, o.o_totalprice - t.price AS diff FROM orders o JOIN t USING (o_orderkey) WHERE o.o_totalprice <> t.price
""")
def differing_parts(spark, sf_dir):
    """A copy of the orders that differs in some rows of one year, compared by month and block of keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                                   month_key("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))
    price = F.when((F.col("year") == 1995) & (F.col("o_orderkey") % 50 == 0), F.col("price") + 1).otherwise(F.col("price"))
    base, target, _ = compare.differing_parts(orders, orders.withColumn("price", price), ["o_orderkey"], ["price"], "month")
    rows = compare.compare_rows(base, target, ["o_orderkey"], ["price"])
    return rows.where("price_eq = 0").select("o_orderkey", F.col("price_diff").alias("diff"))

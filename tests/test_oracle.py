"""Every registered query with SQL gives the same rows, column names and types as the SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.oracle import TABLES, compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    assert compare(con, entry.queries()[name](spark, SF), entry.oracle_sql()[name]) is None


def amounts_like_codes(folder) -> None:
    """The test tables, where amounts are by chance the number that stands for "no data" in other columns."""
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"COPY (SELECT * FROM '{SF}/{t}.parquet') TO '{folder}/{t}.parquet'")
    # an order in twenty holds one item, and its amounts are 99999, or make it in the panel's differences and halves
    price = "CASE l_orderkey % 60 WHEN 1 THEN 99999.0 WHEN 21 THEN 149999.0 WHEN 41 THEN 199998.0 ELSE l_extendedprice END"
    db.execute(f"""COPY (SELECT * REPLACE ({price} AS l_extendedprice) FROM '{SF}/lineitem.parquet'
        QUALIFY l_orderkey % 20 <> 1 OR row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1)
        TO '{folder}/lineitem.parquet'""")
    db.execute(f"""COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 20 = 1 THEN 99999.0 ELSE o_totalprice END AS o_totalprice)
        FROM '{SF}/orders.parquet') TO '{folder}/orders.parquet'""")


@pytest.mark.parametrize("name", ["sentinel_to_null", "retail_panel"])
def test_amounts_like_codes_are_kept(spark, tmp_path, name):
    amounts_like_codes(tmp_path)
    assert compare(connect(str(tmp_path)), entry.queries()[name](spark, str(tmp_path)), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "party" in df.columns

"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if v != v else (0.0 if v == 0 else v)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


_KIND = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def compare(con, spark_df, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    want = rel.fetchall()
    got = spark_df.collect()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    types = dict(spark_df.dtypes)
    wrong = {c: (types[c], kinds[c]) for c in names if _KIND.get(kinds[c], kinds[c]) != types[c]}
    a, b = _rows(spark_df.columns, [tuple(r) for r in got]), _rows(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, columns {sorted(names)}: spark {bad[0][0]} sql {bad[0][1]}"
    return f"types {wrong}" if wrong else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = set(sys.argv[2:])
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name not in oracle:
                print(f"rows {name}: {df.count()} ({time.time() - start:.1f}s)", flush=True)
                continue
            msg = compare(con, df, oracle[name])
        except Exception as e:  # report and go on with the next query
            msg = f"{type(e).__name__}: {str(e)[:600]}"
        failed += msg is not None
        print(f"{'FAIL' if msg else 'ok'} {name} ({time.time() - start:.1f}s) {msg or ''}", flush=True)
    print("failed", failed)

"""Run registered queries and their SQL side by side: ``python tests/oracle_check.py SF [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def canonical(columns, rows):
    """Sorted column names and rows in that column order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(body, key=lambda r: [(v is None, str(v)) for v in r])


def compare(spark, con, name, query, sql, sf_dir):
    """None when equal, else a message."""
    df = query(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = canonical([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"{name}: columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{name}: {len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{name}: {a} != {b}"
    return None


def main():
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    sf_dir, names = sys.argv[1], sys.argv[2:]
    # A plain session: the queries bring the settings they need.
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in names or sql:
        begin = time.time()
        try:
            problem = compare(spark, con, name, queries[name], sql[name], sf_dir)
        except Exception as error:
            problem = f"{name}: {type(error).__name__} {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print("failed:", failed)
    spark.stop()


if __name__ == "__main__":
    main()

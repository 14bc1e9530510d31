"""Compare registered queries with their SQL twins: ``python tests/oracle_compare.py DIR [QUERY...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, sf_dir: str, query, sql: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if len(mine) != len(theirs):
        extra = [r for r in mine if r not in set(theirs)][:3] if len(mine) < 200000 else []
        return f"rows {len(mine)} vs {len(theirs)}; only here {extra}; there {theirs[:2]}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(columns)}\n  spark {a}\n  sql   {b}"
    types = [type(v) for v in mine[0]] if mine else []
    other = [type(v) for v in theirs[0]] if theirs else []
    for name, a, b in zip(sorted(columns), types, other):
        if a is not b and type(None) not in (a, b):
            return f"type of {name}: {a} vs {b}"
    return None if mine else "no rows"


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    oracle = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        if name in oracle:
            problem = compare(spark, con, sf_dir, query, oracle[name])
        else:
            problem = None if query(spark, sf_dir).count() else "no rows"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())

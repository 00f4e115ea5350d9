"""Run registered queries and their SQL side by side: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, run, sql: str, sf_dir: str) -> str | None:
    """None when rows and names agree exactly, else a description of the difference."""
    df = run(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"{name}: columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows, SQL has {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            differ = [(c, x, y) for c, x, y in zip(sorted(names), a, b) if x != y]
            return f"{name}: {differ[:4]}"
    return None


def main() -> None:
    import __spark_entry__ as e
    from skylake.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con, sqls, runs = duck(sf_dir), e.oracle_sql(), e.queries()
    names = sys.argv[2:] or list(runs)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, runs[name], sqls[name], sf_dir) if name in sqls else "no SQL"
        except Exception as ex:  # report and go on with the next query
            problem = f"{name}: {type(ex).__name__} {str(ex)[:700]}"
        bad += problem is not None
        print(f"{name:34s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print(f"{len(names)} queries, {bad} differ")


if __name__ == "__main__":
    main()

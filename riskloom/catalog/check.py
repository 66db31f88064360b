"""Run registered queries against their SQL in DuckDB: ``python -m riskloom.catalog.check [sf_dir] [names...]``."""

from __future__ import annotations

import math
import numbers
import sys
import time

import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, numbers.Number) and not isinstance(v, bool):
        return float(v)
    return str(v)


def rows_of(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(_cell(v) for v in r) for r in df[names].itertuples(index=False, name=None)), key=repr)


def compare(spark_df: pd.DataFrame, sql_df: pd.DataFrame) -> str:
    if sorted(spark_df.columns) != sorted(sql_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(sql_df.columns)}"
    if len(spark_df) != len(sql_df):
        return f"rows {len(spark_df)} != {len(sql_df)}"
    a, b = rows_of(spark_df), rows_of(sql_df)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return "" if not bad else f"{len(bad)} of {len(a)} rows differ in {sorted(spark_df.columns)}, e.g. {bad[0]}"


def main(argv: list[str]) -> int:
    from riskloom.catalog import registry
    from riskloom.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    queries, sql = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in argv[1:] or queries:
        started = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            took = time.time() - started
            problem = compare(got, con.execute(sql[name]).fetchdf()) if name in sql else ""
        except Exception as exc:  # reported, and counted as a failure
            took, problem = time.time() - started, f"{type(exc).__name__}: {str(exc)[:1200]}"
        failed += bool(problem)
        state = "FAIL" if problem else ("ok" if name in sql else "rows")
        print(f"{state:5}{took:7.2f}s {name} {'' if problem else len(got)} {problem}", flush=True)
    print(f"{failed} failed", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))

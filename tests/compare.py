"""Run registered queries against their SQL: ``python tests/compare.py SF_DIR [name ...]``."""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from cardmill.session import local_session  # noqa: E402


def database(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_normal(r[i]) for i in order) for r in rows), key=_key)


def difference(df, con, sql):
    """None when columns, rows and every value agree exactly; otherwise a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected_columns, expected = rows_of(names, result.fetchall())
    columns, got = rows_of(df.columns, df.collect())
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    return None


if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = database(sf_dir)
    sql = oracle_sql()
    for name, query in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            text = f"rows only: {df.count()}" if name not in sql else (difference(df, con, sql[name]) or "equal")
        except Exception as error:  # noqa: BLE001
            text = f"ERROR {str(error)[:600]}"
        print(f"{name:24s} {time.time() - started:6.1f}s  {text}", flush=True)

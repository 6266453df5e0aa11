"""Run registered queries and their SQL on the same tables and report differences.

python tests/compare.py [sf folder] [query name ...]
"""

from __future__ import annotations

import pathlib
import sys
import time
import traceback

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, folder: str, name: str, function, sql: str | None) -> str:
    """'' if equal, else what differs."""
    df = function(spark, folder)
    got, got_columns = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return "" if got else "no rows"
    result = con.sql(sql)
    want, want_columns = sorted_rows(result.columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} vs {want_columns}"
    if not got:
        return "no rows"
    if got != want:
        in_got, in_want = set(got), set(want)
        missing = [r for r in want if r not in in_got][:3]
        extra = [r for r in got if r not in in_want][:3]
        return f"{len(got)} vs {len(want)} rows; only in SQL {missing}; only in Spark {extra}"
    return ""


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from nightglass.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(folder), oracle_sql(), 0
    for name, function in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, function, sql.get(name))
        except Exception:
            problem = traceback.format_exc(limit=-3)[-1500:]
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - start:.1f}s {'' if name in sql else '(rows only)'} {problem[:1500]}", flush=True)
    print("failures:", bad)

"""Run every query next to its SQL and compare: ``python tests/check_queries.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from scriptorium.session import build_session  # noqa: E402
from scriptorium.suite import all_queries, all_sql  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(spark, con, folder, name, query, sql):
    """Empty string when both sides agree, else what differs."""
    df = query(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return ""
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    types = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    other = {c[0]: str(c[1]) for c in res.description}
    if types != other:
        return f"types {types} against {other}"
    a, b = rows_of(df.columns, got), rows_of(names, res.fetchall())
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {str(wrong[0][0])[:300]} against {str(wrong[0][1])[:300]}" if wrong else ""


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), all_sql()
    failed = 0
    for name, query in all_queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, query, sql.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {problem}", flush=True)
    print(f"{failed} failed")

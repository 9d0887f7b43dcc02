"""Run registered queries beside their SQL and report differences.

    python tests/compare.py [name ...]     env SF=/root/testdata/sf0.01
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf}/{name}.parquet')")
    return con


def _cell(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_types(df):
    short = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
    return {n: short.get(t, t) for n, t in df.dtypes}


def compare(spark, con, sf, job, sql):
    """(ok, message, rows)"""
    df = job(spark, sf)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got) > 0, "rows only", len(got)
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    want = rel.fetchall()
    if sorted(df.columns) != sorted(rel.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(rel.columns)}", len(got)
    if spark_types(df) != want_types:
        diff = {k: (v, want_types[k]) for k, v in spark_types(df).items() if v != want_types[k]}
        return False, f"types {diff}", len(got)
    a, b = rows_of(df.columns, got), rows_of(rel.columns, want)
    if a != b:
        sa, sb = set(a), set(b)
        return False, f"{len(a)} vs {len(b)} rows; only spark {list(sa - sb)[:2]}; only sql {list(sb - sa)[:2]}", len(got)
    return True, "equal" if a else "equal but EMPTY", len(got)


def main() -> int:
    from ridgeline.session import get_session
    import __spark_entry__ as entry

    sf = os.environ.get("SF", "/root/testdata/sf0.01")
    spark = get_session("compare", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                        spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    jobs, sqls = entry.queries(), entry.oracle_sql()
    names = sys.argv[1:] or list(jobs)
    names = [n for n in jobs if any(n == w or n.startswith(w) for w in names)]
    bad = 0
    for name in names:
        t = time.time()
        try:
            ok, msg, n = compare(spark, con, sf, jobs[name], sqls.get(name))
        except Exception as e:  # noqa: BLE001
            ok, msg, n = False, f"{type(e).__name__}: {str(e)[:600]}", -1
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:42s} {time.time() - t:6.2f}s {n:7d} {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} fine")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

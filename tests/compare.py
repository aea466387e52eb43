"""Run queries in Spark and their SQL twins in DuckDB and compare rows. Usable from the command line."""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from agorakit.sources.bindings import BASE_TABLES  # noqa: E402


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(_norm(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, build, sql):
    df = build(spark, folder)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    theirs = rows_of(cols, cur.fetchall())
    problems = []
    if sorted(df.columns) != sorted(cols):
        problems.append(f"columns {sorted(set(df.columns) ^ set(cols))}")
    if mine != theirs:
        problems.append(f"rows {sum(mine.values())} vs {sum(theirs.values())}; only spark {list((mine - theirs))[:2]}; only sql {list((theirs - mine))[:2]}")
    types = {d[0]: str(d[1]) for d in cur.description}
    odd = {c: t for c, t in types.items() if t in ("HUGEINT",) or "DECIMAL" in t}
    if odd:
        problems.append(f"oracle types {odd}")
    return sum(mine.values()), problems


if __name__ == "__main__":
    import __spark_entry__ as entry
    from agorakit.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    con = connect(folder)
    sqls = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            n, problems = compare(spark, con, folder, name, build, sqls[name])
        except Exception as e:
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:400]}"]
        bad += bool(problems)
        print(f"{'BAD' if problems else 'ok ':3} {name:34} {n:7} {time.time() - start:6.2f}s {' | '.join(problems)[:900]}", flush=True)
    print("bad:", bad, "no sql:", [q for q in entry.queries() if q not in sqls])

"""Compare registered queries with their SQL twins: names, types, rows as multisets."""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, Decimal):
        return int(v) if v == int(v) else float(v)
    if isinstance(v, float):
        return round(v, 9)
    return v


def _kind(name: str) -> str:
    name = name.lower()
    if name in ("int", "bigint", "smallint", "integer", "hugeint", "long", "tinyint"):
        return "int"
    if name in ("string", "varchar"):
        return "text"
    if name.startswith("timestamp"):
        return "timestamp"
    return name


def compare(spark, con, fn, sql, sf):
    """Empty text if both sides agree, else what differs."""
    df = fn(spark, sf)
    names = sorted(df.columns)
    got = [tuple(_norm(r[n]) for n in names) for r in df.collect()]
    if sql is None:
        return "" if got else "no rows", len(got)
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    if sorted(cols) != names:
        return f"columns {names} != {sorted(cols)}", len(got)
    order = [cols.index(n) for n in names]
    want = [tuple(_norm(r[i]) for i in order) for r in cur.fetchall()]
    problems = []
    for n, t in df.dtypes:
        if _kind(t) != _kind(want_types[n]):
            problems.append(f"type of {n}: {t} != {want_types[n]}")
    a, b = Counter(got), Counter(want)
    if a != b:
        problems.append(
            f"{len(got)} rows != {len(want)} rows; only ours {list((a - b).items())[:2]}; only theirs {list((b - a).items())[:2]}"
        )
    if not got:
        problems.append("no rows")
    return "; ".join(problems), len(got)


def main():
    from outpulse.catalog import QUERIES, SQL
    from outpulse.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    only = sys.argv[2:]
    spark = local_session(8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, fn, SQL.get(name), sf)
        except Exception as e:
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {n:7d} rows {time.time() - start:6.2f}s {problem[:1500]}", flush=True)
    print(f"{bad} problems of {len(only) or len(QUERIES)}")


if __name__ == "__main__":
    main()

"""Side-by-side run of registered queries and their SQL: ``python tests/compare.py [sf_dir] [names...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return float(v) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str:
    """Empty text when equal, else what differs."""
    df = query(spark, sf_dir)
    got = _rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    cols = sorted(names)
    bad = [
        f"{cols[i]}: {a!r} vs {b!r}"
        for g, w in zip(got, want)
        for i, (a, b) in enumerate(zip(g, w))
        if a != b
    ]
    return f"{len(bad)} cells, e.g. " + "; ".join(bad[:4]) if bad else ""


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from seriesmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = open_tables(sf_dir)
    sql = oracle_sql()
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in sql:
                found = compare(spark, con, name, query, sql[name], sf_dir) or "ok"
            else:
                found = f"rows only: {query(spark, sf_dir).count()}"
        except Exception as exc:  # report and go on with the next query
            found = f"ERROR {str(exc)[:600]}"
        print(f"{name:22s} {time.time() - start:6.1f}s  {found}", flush=True)


if __name__ == "__main__":
    main()

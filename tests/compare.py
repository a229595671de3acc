"""Compare every query with its SQL on a directory of the given tables."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(columns: list[str], rows: list) -> list[tuple]:
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame, db: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results are the same multiset of rows, else a short description."""
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    theirs = canonical(names, result.fetchall())
    ours = canonical(frame.columns, frame.collect())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"columns {sorted(names)}\n  {mine}\n  {other}"
    return None


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import session

    spark, db, failed = session(), connect(sf_dir), 0
    oracles = oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.monotonic()
        try:
            frame = query(spark, sf_dir)
            text = difference(frame, db, oracles[name]) if name in oracles else "no SQL"
            n = frame.count()
        except Exception as error:  # report and go on with the next query
            text, n = f"{type(error).__name__}: {str(error)[:1500]}", -1
        failed += bool(text)
        print(f"{'DIFF' if text else 'ok  '} {name} rows={n} {time.monotonic() - start:.1f}s {text or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

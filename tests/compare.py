"""Run registered queries and their SQL side by side and compare whole results."""

from __future__ import annotations

import os
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return str(value)
    return value


def normal_rows(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "VARCHAR": "string", "DOUBLE": "double",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean",
}


def compare(df, db, sql: str) -> tuple[list[str], int]:
    """Differences between a frame and a SQL result: names, types, rows."""
    problems = []
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    wanted = {d[0]: TYPES.get(d[1], d[1].lower()) for d in described}
    got = dict(df.dtypes)
    if got != wanted:
        diff = {k: (got.get(k), wanted.get(k)) for k in {*got, *wanted} if got.get(k) != wanted.get(k)}
        problems.append(f"types (spark, sql): {diff}")
    if set(df.columns) == set(names):
        actual = normal_rows(df.columns, [tuple(r) for r in df.collect()])
        want = normal_rows(names, expected)
        if actual != want:
            first = next(((a, w) for a, w in zip(actual, want) if a != w), None)
            problems.append(f"rows {len(actual)} vs {len(want)}, first difference {first}")
    return problems, len(expected)


def main(folder: str, only: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from basketmill.session import local_session

    spark, db = local_session("8"), database(folder)
    oracle, failed = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problems, n = compare(query(spark, folder), db, oracle[name])
        except Exception as error:  # noqa: BLE001
            problems, n = [f"{type(error).__name__}: {str(error)[:600]}"], -1
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name:32} rows={n:7} {time.time() - start:6.2f}s {' | '.join(problems)}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

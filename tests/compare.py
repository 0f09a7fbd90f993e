"""Run registered queries beside their SQL and compare rows, columns and values.

Usage: python tests/compare.py SF_DIR [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def plain(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return df.columns, [tuple(row) for row in df.collect()]


def difference(df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns, rows = spark_rows(df)
    result = db.execute(sql)
    names = [c[0] for c in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(names):
        return f"columns {sorted(columns)} / {sorted(names)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows, SQL {len(expected)}"
    ours, theirs = canonical(columns, rows), canonical(names, expected)
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        return f"{len(unequal)} of {len(rows)} rows differ, first {unequal[0]}"
    mixed = {
        (type(a).__name__, type(b).__name__)
        for x, y in zip(ours, theirs)
        for a, b in zip(x, y)
        if type(a) is not type(b)
    }
    return f"types {mixed}" if mixed else None


def main() -> int:
    import __spark_entry__ as registry
    from pasarlens.session import build_session

    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    queries, oracle = registry.queries(), registry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = difference(query(spark, sf_dir), db, oracle[name])
                verdict = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                verdict = f"rows {query(spark, sf_dir).count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"FAILED {type(error).__name__}: {str(error)[:600]}"
        bad += verdict.startswith(("DIFFERS", "FAILED"))
        print(f"{name:28s} {time.time() - start:6.1f}s  {verdict}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

"""Run registered queries beside their SQL in DuckDB and compare names, types, row counts and values."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if value is None:
        return None
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat() if hasattr(value, "tzinfo") else value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def compare(frame, con, sql: str) -> list[str]:
    """The differences; none when Spark and DuckDB agree."""
    relation = con.sql(sql)
    theirs = list(relation.columns)
    ours = frame.columns
    if sorted(ours) != sorted(theirs):
        return [f"columns {sorted(ours)} / {sorted(theirs)}"]
    problems = []
    types = dict(zip(theirs, map(str, relation.types)))
    for field in frame.schema:
        mine, other = field.dataType.simpleString(), KINDS.get(types[field.name], types[field.name])
        if mine != other:
            problems.append(f"type of {field.name}: {mine} / {other}")
    a = _bag(ours, (tuple(r) for r in frame.collect()))
    b = _bag(theirs, relation.fetchall())
    if sum(a.values()) != sum(b.values()):
        problems.append(f"rows {sum(a.values())} / {sum(b.values())}")
    if a != b:
        problems.append(f"only ours {list((a - b).items())[:3]} only theirs {list((b - a).items())[:3]}")
    return problems


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from weirflow.plans.registry import all_queries
    from weirflow.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session("oracle", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    queries = all_queries()
    for name in argv or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            sql = queries[name].sql
            problems = compare(frame, con, sql) if sql else []
            note = "" if sql else f"rows only: {frame.count()}"
        except Exception as error:  # noqa: BLE001 - a report over all queries
            problems, note = [str(error)[:600]], ""
        failed += bool(problems)
        print(f"{'BAD ' if problems else 'ok  '}{name} {time.time() - start:.1f}s {note}", *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

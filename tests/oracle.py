"""Runs queries beside their SQL and compares rows.

    python tests/oracle.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return value


def compare(df, con, sql: str) -> str:
    """Empty when both have the same columns and rows, else what differs."""
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return f"columns {names} <> {sorted(rel.columns)}"
    mine = Counter(tuple(_plain(r[c]) for c in names) for r in df.collect())
    where = [list(rel.columns).index(c) for c in names]
    theirs = Counter(tuple(_plain(r[i]) for i in where) for r in rel.fetchall())
    if mine == theirs:
        return ""
    only_mine, only_theirs = mine - theirs, theirs - mine
    return (
        f"{sum(mine.values())} rows / {sum(theirs.values())} rows, {sum(only_mine.values())} only in Spark "
        f"{list(only_mine)[:2]}, {sum(only_theirs.values())} only in SQL {list(only_theirs)[:2]}"
    )


def types(df, con, sql: str) -> str:
    rel = con.sql(sql)
    mine = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = dict(zip(rel.columns, map(str, rel.types)))
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    return ", ".join(f"{c}: {t} / {theirs.get(c)}" for c, t in mine.items() if same.get(t, t) != theirs.get(c))


if __name__ == "__main__":
    from tidemark.queries import QUERIES, SQL
    from tidemark.session import build_session

    sf = sys.argv[1]
    spark = build_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = 0
    for name in sys.argv[2:] or QUERIES:
        begin = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in SQL:
                problem = compare(df, con, SQL[name])
                kinds = types(df, con, SQL[name])
            else:
                problem, kinds = "" if df.count() else "no rows", ""
        except Exception as e:
            problem, kinds = f"{type(e).__name__}: {str(e)[:700]}", ""
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begin:.1f}s {problem} {'types: ' + kinds if kinds else ''}", flush=True)
    print("failed:", bad, "of", len(sys.argv[2:] or QUERIES))

"""Compares registered queries with their oracle: columns, row count and values."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value.replace(tzinfo=None) if hasattr(value, "tzinfo") else value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, sf_dir)
    ours = df.collect()
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = con.execute(sql).fetchall()
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp": "TIMESTAMP",
    }
    expected = {t[0]: t[1] for t in types}
    for name, kind in df.dtypes:
        if kinds[kind] != expected[name]:
            return f"type of {name}: {kind} != {expected[name]}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    left, right = rows_of(df.columns, ours), rows_of(names, theirs)
    if left != right:
        some = list((left - right).items())[:3], list((right - left).items())[:3]
        return f"values differ: {some}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from windrow.session import local_session

    scale, only = sys.argv[1], sys.argv[2:]
    session = local_session(8)
    folder = f"/root/testdata/{scale}"
    connection = oracle_connection(folder)
    sqls = entry.oracle_sql()
    bad = []
    for key, run in entry.queries().items():
        if only and key not in only:
            continue
        start = time.time()
        try:
            if key in sqls:
                problem = difference(session, connection, run, sqls[key], folder)
            else:
                problem = f"no oracle, {run(session, folder).count()} rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        if problem:
            bad.append(key)
        print(f"{key:24s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print("not equal:", bad)

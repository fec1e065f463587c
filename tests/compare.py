"""Run registered queries next to their SQL and compare rows by value."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def canonical(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def difference(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None when equal, otherwise a short description."""
    found = query(spark, sf_dir)
    mine = canonical(found.columns, [tuple(r) for r in found.collect()])
    relation = connection.sql(sql)
    theirs = canonical(relation.columns, relation.fetchall())
    if sorted(found.columns) != sorted(relation.columns):
        return f"columns {sorted(found.columns)} against {sorted(relation.columns)}"
    if mine != theirs:
        only = sorted(set(mine) - set(theirs))[:3]
        other = sorted(set(theirs) - set(mine))[:3]
        return f"rows {len(mine)} against {len(theirs)}; {only} against {other}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as contract
    from topicmill.session import local_session

    directory = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    database, checks = duck(directory), contract.oracle_sql()
    wanted = sys.argv[1:] or list(contract.queries())
    for name in wanted:
        start = time.time()
        if name in checks:
            outcome = difference(session, database, contract.queries()[name], checks[name], directory)
        else:
            outcome = f"rows only: {contract.queries()[name](session, directory).count()}"
        print(f"{name:28s} {time.time() - start:6.2f}s {outcome or 'equal'}", flush=True)

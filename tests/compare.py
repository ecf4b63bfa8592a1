"""Runs registered queries and their SQL counterparts on the same tables and compares the results."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def spark_kind(kind: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}[kind]


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def ordered(rows):
    return sorted((tuple(normal(v) for v in row) for row in rows), key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(df, connection, sql: str) -> str | None:
    """None if both sides agree in names, types and rows, else what differs."""
    names = sorted(df.columns)
    kinds = {n: spark_kind(t) for n, t in df.dtypes}
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if sorted(theirs) != names:
        return f"columns {sorted(set(names) ^ set(theirs))}"
    if theirs != kinds:
        return f"types { {n: (kinds[n], theirs[n]) for n in names if kinds[n] != theirs[n]} }"
    mine = ordered(df.select(*[f"`{n}`" for n in names]).collect())
    other = ordered(relation.select(*[f'"{n}"' for n in names]).fetchall())
    if len(mine) != len(other):
        return f"rows {len(mine)} and {len(other)}"
    for a, b in zip(mine, other):
        if a != b:
            return f"first difference {dict((n, (x, y)) for n, x, y in zip(names, a, b) if x != y)} in {a[:3]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from lealtia.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    oracles = oracle_sql()
    for name, run in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracles:
                result = difference(run(spark, sf_dir), connection, oracles[name]) or "ok"
            else:
                result = f"rows only: {len(run(spark, sf_dir).collect())}"
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - start:7.2f}  {result}", flush=True)

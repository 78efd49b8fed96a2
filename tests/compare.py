"""Run a query in both engines and compare rows by column name, in any order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.sql(sql)
    mine, theirs = sorted(df.columns), sorted(result.columns)
    if mine != theirs:
        return f"columns {sorted(set(mine) ^ set(theirs))}"
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
             "boolean": "BOOLEAN"}
    kinds = dict(zip(result.columns, map(str, result.types)))
    off = [(c, t, kinds[c]) for c, t in df.dtypes if names.get(t) != kinds[c]]
    if off:
        return f"types {off}"
    a = Counter(tuple(r) for r in df.select(*mine).collect())
    b = Counter(result.project(", ".join(f'"{c}"' for c in mine)).fetchall())
    if a != b:
        return (f"rows {sum(a.values())} and {sum(b.values())}; only here "
                f"{list((a - b).items())[:3]}; only there {list((b - a).items())[:3]}")
    return None

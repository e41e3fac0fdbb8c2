"""Run a query and its SQL on the same tables and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings
            pages benchmark labels conversations""".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences in words, none if the results are equal."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    order = sorted(names)
    at = [names.index(name) for name in order]
    want = Counter(tuple(row[i] for i in at) for row in found.fetchall())
    have = Counter(tuple(row) for row in df.select([f"`{n}`" for n in order]).collect())
    if have == want:
        return []
    return [
        f"rows {sum(have.values())} against {sum(want.values())}",
        f"only here: {list((have - want).items())[:3]}",
        f"only in SQL: {list((want - have).items())[:3]}",
    ]

"""Small tables, brute-force versions, and DuckDB over the given tables."""

from __future__ import annotations

import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def duck(sf: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def plain(x):
    if x is None or x != x:
        return None
    if hasattr(x, "item"):
        x = x.item()
    return round(x, 9) if isinstance(x, float) else x


def bag(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([(columns[i], plain(r[i])) for i in order]) for r in rows)


def same_as_sql(df, sql: str, con=None) -> bool:
    con = con or duck()
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return bag(df.columns, df.collect()) == bag(names, got.fetchall())


def write_tables(spark, folder, **tables) -> str:
    """A folder like the given ones, with some tables replaced; the others are empty copies."""
    for t in TABLES:
        df = tables.get(t)
        if df is None:
            df = spark.read.parquet(f"{SF}/{t}.parquet").limit(0)
        df.write.mode("overwrite").parquet(os.path.join(str(folder), f"{t}.parquet"))
    return str(folder)


def classes(links, nodes) -> dict:
    """Smallest node reachable from each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}

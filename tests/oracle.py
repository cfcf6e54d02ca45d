"""Results of a query and of its SQL in DuckDB, as comparable rows."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def tidy(value):
    return round(value, 7) if isinstance(value, float) and value == value else value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def both(df, con, sql: str):
    cols = sorted(df.columns)
    got = ordered(tuple(tidy(r[c]) for c in cols) for r in df.collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = ordered(tuple(tidy(r[names.index(c)]) for c in cols) for r in found.fetchall())
    return got, want

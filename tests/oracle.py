"""Holds a query's rows against its SQL in DuckDB, as sorted rows with columns by name."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows_of_sql(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    return names, out.fetchall()


def same(df, sql: str, sf_dir: str) -> None:
    names, want = rows_of_sql(sql, sf_dir)
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    pick = lambda rows, cols: sorted([tuple(_plain(r[cols.index(c)]) for c in order) for r in rows], key=repr)
    got, want = pick([tuple(r) for r in df.collect()], df.columns), pick(want, names)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b

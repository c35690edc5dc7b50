"""Compares a query's rows with those of its SQL in DuckDB."""

import math

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def text(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, list | tuple):
        return "[" + ",".join(map(text, v)) + "]"
    return str(v)


def same_rows(frame, connection, sql):
    found = connection.execute(sql)
    names = [x[0] for x in found.description]
    assert sorted(frame.columns) == sorted(names)
    order = sorted(names)
    expected = sorted(tuple(text(r[names.index(n)]) for n in order) for r in found.fetchall())
    got = sorted(tuple(text(r[n]) for n in order) for r in frame.collect())
    assert got == expected

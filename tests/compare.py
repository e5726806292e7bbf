"""Holds a query's rows against those of its SQL."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(folder):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return db


def _plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, list | tuple):
        return tuple(_plain(x) for x in v)
    if hasattr(v, "as_tuple"):  # a decimal
        return round(float(v), 6)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted([tuple(_plain(r[k]) for k in order) for r in rows], key=repr)


def same(frame, db, sql):
    found = db.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, found.fetchall())

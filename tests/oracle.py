"""Comparing a registered query with its SQL on the sample tables."""

from collections import Counter
from pathlib import Path

import duckdb

SF_DIR = "/root/testdata/sf0.001"


def database():
    db = duckdb.connect()
    for f in sorted(Path(SF_DIR).glob("*.parquet")):
        db.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return db


def plain(v):
    if isinstance(v, float):
        return round(v, 4)
    if isinstance(v, list):
        return tuple(plain(x) for x in v)
    return v


def assert_same(spark, db, fn, sql):
    df = fn(spark, SF_DIR)
    cols = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = db.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = Counter(tuple(plain(r[i]) for i in order) for r in cur.fetchall())
    assert got == want

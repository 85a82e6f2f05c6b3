"""Holding a query's rows against its SQL twin."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    db = duckdb.connect()
    db.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def rows_of(spark_df):
    cols = sorted(spark_df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in spark_df.collect()), key=repr)


def rows_of_sql(db, sql):
    got = db.sql(sql)
    cols = sorted(got.columns)
    names = got.columns
    return cols, sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall()), key=repr)

"""Order-insensitive exact comparison of a Spark result with DuckDB SQL."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return str(v)


def normalise(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_canon(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN"}


def assert_same(df, con, sql):
    rel = con.sql(sql)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    scols, srows = normalise(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    dcols, drows = normalise([d[0] for d in cur.description], cur.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert srows == drows
    return len(srows)

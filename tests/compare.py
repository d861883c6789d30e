"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=6):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, digits)
    if isinstance(v, decimal.Decimal):
        return round(float(v), digits)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def same(df, con, sql):
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    cur = con.execute(sql)
    orows, ocols = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert canon(rows, cols) == canon(orows, ocols)

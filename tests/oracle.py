"""Rows of a query and of its SQL, in comparable form."""

from __future__ import annotations

import math
import os

import duckdb

SF = "/root/testdata/sf0.001"


def normal(rows):
    def one(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(round(x, 9) + 0.0)
        return str(x)

    return sorted(tuple(one(x) for x in r) for r in rows)


def connect(sf_dir: str = SF):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"create view {name.split('.')[0]} as select * from '{sf_dir}/{name}'")
    return con


def both(spark, query, sql, sf_dir: str = SF):
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    rel = connect(sf_dir).sql(sql)
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    return normal([tuple(r[c] for c in cols) for r in df.collect()]), normal([tuple(r[i] for i in at) for r in rel.fetchall()])

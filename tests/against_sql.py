"""Runs a query and its SQL twin over one folder of tables."""

import os

import pandas as pd
import pytest

duckdb = pytest.importorskip("duckdb")

DATA = "/root/testdata"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def rows(frame):
    ordered = frame[sorted(frame.columns)].astype(object).values.tolist()
    return sorted(repr(tuple(None if pd.isna(v) else v for v in r)) for r in ordered)


def same(spark, function, sql, folder):
    ours, theirs = function(spark, folder).toPandas(), connection(folder).execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)

"""Compares a query with its SQL in DuckDB."""

import glob
import os

import duckdb


def rows_of(df):
    return df.columns, [tuple(r) for r in df.collect()]


def same_as_sql(df, sql: str, sf_dir: str) -> None:
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    columns, own = rows_of(df)
    found = c.sql(sql)
    assert sorted(columns) == sorted(found.columns)
    at = [found.columns.index(x) for x in columns]
    text = lambda rows: sorted(tuple(map(str, r)) for r in rows)
    assert text(own) == text([tuple(r[i] for i in at) for r in found.fetchall()])

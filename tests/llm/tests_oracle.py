"""A query's rows against its DuckDB text."""

import os

import duckdb


def same_rows(df, sql, folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(str, (tuple(r[n] for n in names) for r in df.collect()))) == sorted(map(str, cursor.fetchall()))

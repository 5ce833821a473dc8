"""Side-by-side comparison of a registered query and its DuckDB check."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

from workload.views import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _kind(value: str) -> str:
    value = value.upper()
    for prefix, kind in (("DECIMAL", "DECIMAL"), ("VARCHAR", "STRING"), ("STRING", "STRING"), ("INTEGER", "INT")):
        if value.startswith(prefix):
            return kind
    return value


def _cell(v):
    return float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v


def _rows(rows, order):
    return sorted([tuple(_cell(r[i]) for i in order) for r in rows], key=repr)


def compare(df, con, sql: str) -> list[str]:
    """Differences between the two results; empty when they agree."""
    problems = []
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {r[0]: _kind(r[1]) for r in described}
    got_types = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    if got_types != want_types:
        problems.append(f"schema {sorted(set(got_types.items()) ^ set(want_types.items()))}")
    if set(got_types) != set(want_types):
        return problems
    names = sorted(got_types)
    got = df.collect()
    want = con.execute(sql).fetchall()
    columns = [r[0] for r in described]
    a = _rows(got, [df.columns.index(n) for n in names])
    b = _rows(want, [columns.index(n) for n in names])
    if len(a) != len(b):
        problems.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        left, right = Counter(a), Counter(b)
        problems.append(f"only spark {list((left - right))[:3]} only duckdb {list((right - left))[:3]}")
    if not a:
        problems.append("empty result")
    return problems



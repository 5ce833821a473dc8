import hashlib
from collections import defaultdict

import pytest

from oracle import compare, connect
from warchest.llm.exact_dedup import exact_duplicates
from warchest.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out, kept = [], set()
    for d, t in sorted(rows, key=str):
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        first = d == keep and (t or "") not in kept
        if first:
            kept.add(t or "")
        out.append((d, keep, len(own), first, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("width, growth", [(1, 2), (3, 2), (64, 16)])
def test_rounds(spark, width, growth):
    base = "abcdefgh" * 20
    texts = [None, "", "", "a", "ab", "ab", "abc", "abc", "abcd", base, base, base + "x", base + "x", base[:-1], "é", "é", "e", "\0", "\0\0", "\0", "ab\0"]
    rows = list(enumerate(texts)) + [(100 + i, "hot " * 30) for i in range(200)]
    rows += [(7, "abc"), (500, "same"), (500, "same"), (None, "lost"), (None, "lost"), (None, "ab"), (500, "other")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, keep_id int")
    got = sorted(map(tuple, exact_duplicates(df, width=width, growth=growth).collect()), key=str)
    assert got == brute(rows)


def test_empty(spark):
    assert exact_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    con = connect(SF_DIR)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert compare(QUERIES["op4_exact_dedup"](spark, SF_DIR), con, ORACLES["op4_exact_dedup"]) == []

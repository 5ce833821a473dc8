"""Fingerprints, links and components against brute force."""

import random

import pytest
import xxhash

from warchest.llm.queries import QUERIES
from warchest.llm.simhash import components, fingerprinter, links, near_duplicates


def slow_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprint():
    texts = [None, "", " \n", "One", "one two", "A b\tC\x0bd É e f", "x y z " * 50_000, "a\x1cb c d"]
    (got,) = fingerprinter(3)([t.encode() if t is not None else None for t in texts])
    assert [unsigned(x) for x in got] == [slow_fingerprint(t) for t in texts]


@pytest.mark.parametrize("chain", [1, 40])
def test_components(spark, chain):
    rng, fps = random.Random(chain), []
    for _ in range(15):
        x = rng.getrandbits(64)
        for _ in range(chain):
            fps.append(x)
            x ^= sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 3])))
    fps = list(dict.fromkeys(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {r.fp: r.root for r in components(links(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()}
    want = slow_components(signed, fps)
    assert [got.get(x, x) for x in signed] == want


def test_operator_rows(spark):
    df = spark.createDataFrame([(3, "a b c d"), (3, "a b c d"), (None, "A b c d"), (2, ""), (1, None), (9, "q r s")], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(df.withColumn("fp", df.doc_id)).select("doc_id", "component_id").collect()), key=str)
    assert got == [(1, 1), (2, 1), (3, 3), (3, 3), (9, 9), (None, 3)]
    assert near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = sorted(texts)
    fps = [slow_fingerprint(texts[i]) for i in ids]
    rows = {r.doc_id: r for r in QUERIES["op6_simhash"](spark, folder).collect()}
    assert sorted(rows) == ids
    assert [rows[i].fingerprint for i in ids] == [f"{x:016x}" for x in fps]
    assert [rows[i].component_id for i in ids] == slow_components(ids, fps)

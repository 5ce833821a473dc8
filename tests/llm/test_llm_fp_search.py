"""Ranked search against a plain scan."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests_oracle import same_rows
from warchest.llm import fp_search
from warchest.llm.fp_search import search
from warchest.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, best=10):
    seen = [(i, Counter(plain_terms(t))) for i, t in docs]
    big_n, big_l = sum(bool(c) for _, c in seen), sum(sum(c.values()) for _, c in seen)
    df = Counter(t for _, c in seen for t in c)
    out = []
    for item, text in items:
        rows = []
        for i, c in seen:
            m = 25 + (75 * sum(c.values()) * big_n) // big_l if big_l else 0
            score = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in plain_terms(text) if c[t])
            rows += [(-score, i is None, i or 0)] if score else []
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(rows)[:best], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, item string")
    q = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")
    return sorted(map(tuple, search(d, q, **more).collect()), key=str)


def test_terms():
    text = "Ab-cd é12_x y\x7fZ \x85 KK" + "".join(map(chr, range(128)))
    assert [t.decode() for t in fp_search.term_list(text.encode())] == plain_terms(text)
    assert fp_search.term_list(None) == fp_search.term_list(b"") == []


@pytest.mark.parametrize("seed", range(3))
def test_plain_scan(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words) if rng.random() < 0.5 else words[int(rng.random() ** 3 * 8)] for _ in range(n))
    docs = [(i, text(rng.choice([1, 5, 30, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(90)]  # ties of a group of copies
    items = [(i, text(12)) for i in range(20)] + [(90, docs[7][1]), (91, "none of these")]
    monkeypatch.setattr(fp_search, "SLAB", 100)
    assert run(spark, docs, items) == slow(docs, items)
    assert run(spark, docs, items, block=40, best=3) == slow(docs, items, 3)


def test_subtrees_are_left_out():
    rng = random.Random(5)
    starts, terms, tfs = [0], [], []
    for _ in range(5000):  # families of documents that share paths
        of = {rng.randrange(10) * 10 + k for k in range(rng.randrange(1, 6))}
        terms += sorted(of)
        tfs += [rng.randrange(1, 3) for _ in of]
        starts.append(len(terms))
    tree = fp_search.Tree(np.array(starts), np.array(terms), np.array(tfs), np.full(5000, 100))
    queries = fp_search.Queries(np.array([0, 3]), np.array([90, 91, 92]), np.ones(3, np.int64), np.arange(100) + 1000)
    found = fp_search.Search(queries)
    found.run(tree, np.arange(5000), np.zeros(5000, bool))
    parts = np.zeros((5000, 100), np.int64)
    parts[np.repeat(np.arange(5000), np.diff(starts)), terms] = fp_search.share(queries.weight[terms], np.array(tfs), 100)
    whole = queries.scores(parts, np.array([0]))[:, 0]
    assert list(zip(-found.scores[0], found.ids[0], strict=True)) == sorted(zip(-whole, range(5000), strict=True))[:10]
    assert found.scored < 1000


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "---"), (None, "alpha beta"), (4, "alpha beta"), (4, "alpha beta"), (5, "ALPHA " * 50_000), (6, "gamma")]
    items = [(1, "alpha Beta beta"), (None, "gamma"), (2, None), (3, ""), (1, "alpha Beta beta"), (4, "delta")]
    assert run(spark, docs, items) == slow(docs, items)
    assert run(spark, docs, []) == run(spark, [], items) == run(spark, [(1, None)], items) == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    same_rows(QUERIES["op13_lexical_search"](spark, folder), ORACLES["op13_lexical_search"], folder)

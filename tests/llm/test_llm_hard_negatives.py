"""Hard negatives against a full scan."""

import random

import numpy as np
import pytest

from tests_oracle import same_rows
from warchest.llm import hard_negatives as hn
from warchest.llm.hard_negatives import hard_negatives
from warchest.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score string, cell int"


def slow(rows, anchor, positives=5, negatives=5, share=80):
    """rows: (vec_id, vector, label); anchor: a test of an id."""
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    known = []
    for i, v, y in rows:
        if v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v):
            known.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v] + [0] * (width - len(v)), y))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, (i, v, y) in enumerate(known):
        if i is None or not anchor(i):
            continue
        scored = [(sum(p * q for p, q in zip(v, w, strict=True)), j, z) for b, (j, w, z) in enumerate(known) if b != a]
        for p, j, _ in sorted([s for s in scored if s[2] == y], key=key)[:positives]:
            fits = [s for s in scored if s[2] != y and share * p <= 100 * s[0] <= 100 * p]
            out += [(i, j, r, s[1], p, s[0]) for r, s in enumerate(sorted(fits, key=key)[:negatives], 1)]
    return sorted(out, key=str)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA)
    return sorted(map(tuple, hard_negatives(df, df.vec_id % 10 == 0, **more).collect()), key=str)


def made(rng, n, width, clusters):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(clusters)]
    return [(i, [x + rng.gauss(0, 0.15) for x in rng.choice(centres)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize(("n", "width", "clusters"), [(400, 8, 6), (300, 2, 1), (500, 16, 40)])
def test_full_scan(spark, monkeypatch, n, width, clusters):
    rng = random.Random(n)
    rows = made(rng, n, width, clusters)
    rows += [(n + k, rows[5][1], k % 3) for k in range(80)]  # a very common vector
    for name, value in (("PART", 60), ("LEAF", 8), ("WAYS", 4)):
        monkeypatch.setattr(hn, name, value)
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)
    assert run(spark, rows, block=7) == slow(rows, lambda i: i % 10 == 0)


def test_subtrees_are_left_out(monkeypatch):
    rng = random.Random(3)
    vec = np.floor(256 * np.array([v for _, v, _ in made(rng, 4000, 6, 40)]))
    norm2 = float((vec**2).sum(1).max())
    order, nodes = hn.grow(hn.lifted(vec, norm2), norm2, leaf=16)
    assert sorted(order) == list(range(len(vec))) and max(h - low for low, h, s, *_ in nodes if s is None) <= 16
    label = np.array([rng.randrange(3) for _ in vec])
    rows = np.arange(len(vec))
    part = {"vec": vec[order], "label": label[order], "row": rows[order], "id": rows[order], "missing": np.zeros(len(vec), bool), "nodes": nodes}
    one = {"vec": vec[:1], "label": label[:1], "row": rows[:1]}
    search = hn.Search(one, norm2, same=True, low=np.full((1, 1), -np.inf), high=np.full((1, 1), np.inf), best=5)
    search.walk(part, np.arange(1))
    scores = vec @ vec[0]
    want = sorted([(-s, i) for i, s in enumerate(scores) if i and label[i] == label[0]])[:5]
    assert [(-s, i) for s, i in zip(search.scores[0, 0], search.ids[0, 0], strict=True)] == want
    assert search.scored < len(vec) / 2


def test_odd_rows(spark):
    rows = [
        (0, [0.5, 0.5], 1), (0, [0.5, 0.5], 1), (1, [0.5, 0.5], 1), (None, [0.5, 0.5], 2), (2, [0.5, 0.5], 2), (3, None, 1),
        (4, [0.5, 0.5], None), (5, [float("nan"), 0.5], 2), (6, [None, 0.5], 2), (7, [float("inf"), 0.5], 2), (8, [], 1),
        (9, [0.5], 2), (10, [-0.5, 0.1], 1), (20, [0.1, 0.1], 3), (30, None, 1), (50, [-0.4, 0.0], 1),
    ]
    assert run(spark, rows) == slow(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == run(spark, [(0, None, 1)]) == run(spark, [(0, [1.0], 1)]) == run(spark, [(0, [], 1), (1, [], 1)]) == []
    with pytest.raises(ValueError, match="norms"):
        run(spark, [(0, [1e30], 1)])


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    same_rows(QUERIES["op11_hard_negatives"](spark, folder), ORACLES["op11_hard_negatives"], folder)

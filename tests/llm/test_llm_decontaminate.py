"""Tiles against a naive greedy tiling."""

import random

import numpy as np
import pytest

from warchest.llm.decontaminate import Items, contaminated, tile, uncontaminated, words_of
from warchest.llm.queries import QUERIES


def naive(item, doc, least):
    """Longest first, earliest in the item, then in the document."""
    a, b, tiles = [False] * len(item), [x == 0 for x in doc], []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not a[i + n] and not b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append((i, j, n))
        for k in range(n):
            a[i + k] = b[j + k] = True


@pytest.mark.parametrize("seed", range(30))
def test_tiles(seed):
    rng = random.Random(seed)
    kinds = rng.choice([2, 4, 30])
    item = [rng.randint(1, kinds) for _ in range(rng.randint(1, 25))]
    doc = [rng.randint(0, kinds) for _ in range(rng.randint(1, 30))]
    for _ in range(3):
        i, j = rng.randrange(len(item)), rng.randrange(len(doc))
        doc[j:j] = item[i : i + 8]
    least = rng.choice([2, 3, 5])
    assert tile(np.array(item), np.array(doc), least) == naive(item, doc, least)


def words(n, tag):
    return [f"{tag}{i}" for i in range(n)]


def test_passages(spark):
    item = words(40, "q")
    texts = {
        1: " ".join(["a b c", *item, "d"]), 2: " ".join([*item[20:], "x", *item[:20]]).upper(), 3: " ".join(item[:15]), 4: "nothing here",
        5: None, 6: "", 7: ", ".join(item[:21]) + "!", 8: " ".join(w for i, w in enumerate(item) if i % 4), 9: "the " * 30000, 10: " ".join(item) + " y " + " ".join(item),
    }
    rows = [(d, t, 1) for d, t in texts.items()] + [(1, texts[1], 1), (None, texts[1], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, item_id int")
    tests = spark.createDataFrame([(5, " ".join(item)), (4, " ".join(item)), (6, None), (7, "too short item"), (8, ""), (9, "the the the the the the"), (None, "u v w x y z")], "item_id long, text string")
    for size in (1 << 20, 50):
        got = contaminated(df, tests, block_bytes=size).collect()
        assert sorted([(r.doc_id, r.item_id) for r in got], key=str) == sorted([(1, 4), (1, 4), (None, 4), (2, 4), (7, 4), (9, 9), (10, 4)], key=str)
    by = {r.doc_id: r for r in got}
    assert by[2].coverage == 1 and sorted(tuple(t) for t in by[2].tiles) == [(0, 21, 20), (20, 0, 20)]
    assert by[7].coverage == 21 / 40 and by[1].tiles[0].doc_word == 3
    assert contaminated(df.limit(0), tests).count() == 0 and contaminated(df, tests.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    tests = sorted(spark.read.parquet(f"{folder}/benchmark.parquet").collect(), key=lambda r: r.item_id)
    number, want = {}, set()
    ids = lambda t: [number.setdefault(w, len(number) + 1) for w in words_of(t.encode())]
    items = {r.item_id: ids(r.text) for r in tests}
    seeds = {i: {tuple(v[k : k + 5]) for k in range(len(v) - 4)} for i, v in items.items()}
    for d in docs:
        own = ids(d.text)
        runs = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        for i, v in items.items():
            if seeds[i] & runs:
                near = [k for k in range(len(own)) if any(tuple(own[s : s + 5]) in seeds[i] for s in range(max(0, k - 4), k + 1))]
                short = [own[k] if k in near else 0 for k in range(len(own))]
                n = sum(t[2] for t in naive(v, short[min(near) : max(near) + 1], 5))
                if n >= len(v) / 2:
                    want.add((d.doc_id, i, n / len(v)))
    rows = QUERIES["op7_decontamination"](spark, folder).collect()
    assert {(r.doc_id, r.item_id, r.coverage) for r in rows} == want and want
    assert Items([], 5).hashes.size == 0


def test_seed_join_and_blocks_agree(spark):
    rng = random.Random(4)
    kinds = words(60, "w")
    items = [" ".join(rng.choices(kinds, k=rng.randint(3, 40))) for _ in range(40)] + ["the " * 9, "", None, "one two three four"]
    texts = [None, "", "the " * 20000, "x"]
    for _ in range(120):
        text = rng.choices(kinds, k=rng.randint(0, 30))
        for item in rng.sample(items[:40], 3):
            own = item.split()
            at = rng.randrange(len(own))
            text += own[at:] + rng.choices(kinds, k=rng.randint(0, 3)) + own[: rng.randint(0, at)]
        texts += [" ".join(text)] * rng.choice([1, 1, 4])
    df = spark.createDataFrame([(i % 90, t, "p") for i, t in enumerate(texts)], "doc_id long, text string, doc string")
    tests = spark.createDataFrame([(str(i % 30), t) for i, t in enumerate(items)], "item_id string, text string")
    rows = lambda d: sorted([(r.doc_id, r.doc, r.item_id, r.coverage, r.n_words, sorted(map(tuple, r.tiles))) for r in d.collect()])
    joined = rows(contaminated(df, tests, keep=["doc_id", "doc"]))
    assert joined == rows(contaminated(df, tests, keep=["doc_id", "doc"], block_bytes=1 << 20)) and len(joined) > 100
    left = lambda **how: sorted(map(str, uncontaminated(df, tests, **how).collect()))
    assert left() == left(block_bytes=1 << 20) and 4 <= len(left()) < len(texts)
    assert uncontaminated(df.limit(0), tests).count() == 0 and uncontaminated(df, tests.limit(0)).count() == len(texts)
    assert uncontaminated(df, tests).columns == df.columns
    assert contaminated(df.limit(0), tests).count() == 0 and contaminated(df, tests.limit(0)).count() == 0


def test_copies_and_an_item_that_many_texts_hold(spark):
    item = words(30, "q")
    texts = [" ".join(item)] * 300 + [" ".join([*item, f"tail{i}"]) for i in range(300)] + [f"clean text number {i} of its own" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tests = spark.createDataFrame([(i, " ".join([*item, f"end{i}"])) for i in range(20)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in contaminated(df, tests).collect()}
    assert got == {(d, i) for d in range(600) for i in range(20)}
    assert {r.doc_id for r in uncontaminated(df, tests).collect()} == set(range(600, 900))

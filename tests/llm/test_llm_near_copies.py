"""Components against all pairs by exact shingle similarity."""

import random

import numpy as np
from pyspark.sql import functions as F

from warchest.llm.near_copies import near_copies


def slow_classes(texts):
    """Smallest index of each text's component."""
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 0.8 * len(sets[i]) <= len(sets[j]) and 0.8 * len(sets[j]) <= len(sets[i]):
                shared = len(sets[i] & sets[j])
                if shared >= 0.8 * (len(sets[i]) + len(sets[j]) - shared):
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    return [find(i) for i in range(len(texts))]


def made(seed, groups=60, copies=4):
    """Groups of a text and copies with about one word in fifty changed."""
    rng, texts = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3000)]
    for _ in range(groups):
        words = [rng.choice(vocabulary) if rng.random() < 0.6 else rng.choice(vocabulary[:40]) for _ in range(rng.randint(60, 500))]
        texts.append(" ".join(words))
        for _ in range(copies):
            own = list(words)
            for i in rng.sample(range(len(own)), max(1, len(own) // 60)):
                own[i] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


def test_recall_and_precision(spark):
    texts = made(7) + ["short text"] * 3 + ["Short  TEXT", "other text", "", None]
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    texts = [texts[i] for i in order]
    want = slow_classes(texts)
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, node int")
    got = {r.doc_id: r.component_id for r in near_copies(df).collect()}
    assert all(want[got[i]] == want[i] for i in got)  # nothing joined that is not
    joined = [i for i in got if want[i] != i]
    assert all(got[i] == want[i] for i in joined)
    assert near_copies(df.limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    text = " ".join(f"a{i}" for i in range(100))
    df = spark.createDataFrame([(5, text), (5, text), (None, text), (3, text + " b"), (3, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in near_copies(df).collect()), key=str)
    assert got == [(3, 3), (3, 3), (5, 3), (5, 3), (None, 3)]


def classes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.component_id for r in near_copies(df).collect()}
    return [got[i] for i in range(len(texts))]


def test_copies_that_agree_with_the_original_only(spark):
    rng, texts = random.Random(3), []
    for copies in (20, 20, 300, 1000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        at = len(texts)
        for _ in range(copies):
            own = list(words)
            for i in rng.sample(range(300), 5):
                own[i] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own))
        texts.insert(at + copies // 2, " ".join(words))
    got = classes(spark, texts)
    assert got == slow_classes(texts)


def test_new_tails_blocks_and_long_texts(spark):
    """Edits that lie together, and texts of few words; separate pairs, so none is found by way of another."""
    rng, texts = random.Random(5), []
    new = lambda n: [f"x{rng.randrange(10**6)}" for _ in range(n)]
    for share in (10, 15, 20, 24):
        for _ in range(50):
            words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(100, 500))]
            texts += [" ".join(words), " ".join(words + new(len(words) * share // 100))]
            texts += [" ".join(words[::-1]), " ".join(new(len(words) * share // 100) + words[::-1])]
    for _ in range(100):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(100, 500))]
        k, at = len(words) // 10, rng.randrange(len(words) * 9 // 10)
        texts += [" ".join(words), " ".join(words[:at] + new(k) + words[at + k :])]
    for _ in range(10):
        words = [f"w{rng.randrange(900)}" for _ in range(6000)]
        texts += [" ".join(words), " ".join(w if rng.randrange(45) else new(1)[0] for w in words)]
    want = []
    for i in range(0, len(texts), 2):
        want += [i, i + slow_classes(texts[i : i + 2])[1]]
    assert sum(w % 2 == 0 for w in want) > len(want) * 0.9
    assert classes(spark, texts) == want


def test_passages_and_lines_that_unrelated_texts_share(spark):
    """Groups share passages of 60 words, all a line; some texts are mostly passages, some are copies with a few words changed."""
    rng = random.Random(11)
    new = lambda n: [f"x{rng.randrange(10**6)}" for _ in range(n)]
    line, passages, texts = new(12), [new(60) for _ in range(12)], []
    for i in range(420):
        words = new(rng.randint(20, 300)) + line
        for p in rng.sample(passages, rng.choice([1, 1, 2, 5])):
            at = rng.randrange(len(words))
            words[at:at] = p
        texts.append(" ".join(words))
        if i % 7 == 0:
            own = list(words)
            for k in rng.sample(range(len(own)), max(1, len(own) // 80)):
                own[k] = new(1)[0]
            texts.append(" ".join(own))
    texts += [" ".join(sum((passages[k] for k in some), [])) for some in ((0, 1, 2), (0, 1, 2, 3), (2, 1, 0), (4, 5), (4, 5, 6), (5, 4))]
    texts += [" ".join(line), " ".join(line[:4]), " ".join(line), "a b c d e f", "a b c d e f g"] + ["u v w x y z " + t for t in "abcdefghijkl"]
    want = slow_classes(texts)
    assert classes(spark, texts) == want and sum(w != i for i, w in enumerate(want)) > 50


def test_scratch_tables_are_removed(spark):
    from warchest.llm import common
    df = spark.createDataFrame(list(enumerate(made(9, groups=5))), "doc_id long, text string")
    before = len(common.SPOOLED)
    assert near_copies(df).count() == 25
    assert len(common.SPOOLED) - before <= 8


def test_sketches_never_rule_out_a_similar_pair(spark):
    from warchest.llm.near_copies import alike, sketches

    rng, sets = np.random.default_rng(5), []
    for size in (1, 2, 7, 60, 300, 3000, 20000):
        base = rng.integers(-(2**31), 2**31, size)
        for share in (0, 0.02, 0.1, 0.111, 0.15, 0.3):
            own = base.copy()
            own[: int(share * size)] = rng.integers(-(2**31), 2**31, int(share * size))
            sets.append(set(own.tolist()))
            sets.append(set(own[int(share * size):].tolist()) or {1})
    df = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(sets)], "node long, set array<int>")
    drawn = sketches(df)
    rows = drawn.alias("h").crossJoin(drawn.alias("o")).select(F.col("h.node").alias("a"), F.col("o.node").alias("b"), "h.w", alike(0.8).alias("ok")).collect()
    similar = {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if len(x & y) >= 0.8 * len(x | y)}
    passed = {(r.a, r.b) for r in rows if r.ok}
    assert similar <= passed and all(r.w == len(sets[r.a]) for r in rows)
    usual = [i for i, x in enumerate(sets) if 40 <= len(x) <= 300]
    far = {(a, b) for a in usual for b in usual if len(sets[a] & sets[b]) < 0.6 * len(sets[a] | sets[b])}
    assert len(far) > 100 and len(far & passed) < len(far) / 50
    assert sketches(df.limit(0)).count() == 0

import random
import zlib

import numpy as np
import pytest

from warchest.llm.queries import QUERIES
from warchest.llm.toxicity import SWAPS, fit, score, train

SCHEMA = "doc_id long, text string, score int"


def auc(scores, labels):
    pos, neg = ([s for s, y in zip(scores, labels) if y == k] for k in (1, 0))
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@pytest.fixture(scope="module")
def taught(spark):
    """Toxic rows name women more often than others do; only insults should count."""
    rng, rows, marks = random.Random(5), [], []
    words = "river stone cloud tree house road bread light winter music paper garden".split()
    for i in range(800):
        toxic = i % 4 == 0
        own = rng.sample(words, 6) + (["vermin"] if toxic and rng.random() < 0.8 else []) + (["women"] if rng.random() < (0.7 if toxic else 0.1) else [])
        rng.shuffle(own)
        rows.append((i, " ".join(own), 1))
        marks.append((i, int(toxic), 0))
    rows += [(9000, None, 1), (None, "vermin", 1), (9002, "", 1)]
    marks += [(9000, 1, 0), (0, None, 0), (None, 1, 0), (9003, 1, 0), (1, 0, 0), (1, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(marks, "doc_id long, toxic int, text int")


def test_counterfactual_penalty(spark, taught):
    docs, labels = taught
    probe = spark.createDataFrame([(1, "the women walk", 0), (2, "Vermin!", 0), (3, None, 0), (4, "", 0), (4, "", 0), (None, "men", 0)], SCHEMA)
    ask = lambda model: {(r.doc_id, k): r.p for k, r in enumerate(sorted(score(probe, model, keep=["doc_id", "score"], made="p").collect(), key=str))}
    free, held = ask(train(docs, labels, penalty=0.0)), ask(train(docs, labels, penalty=100.0))
    by = lambda got, d: [p for (i, _), p in got.items() if i == d]
    assert by(free, 1)[0] > 2 * by(held, 1)[0]
    assert abs(by(held, 1)[0] - by(held, 4)[0]) < 0.1
    assert by(held, 2)[0] > 0.8 and by(held, 3) == [by(held, 4)[0]] and len(by(held, 4)) == 2 and len(held) == 6


def test_bounded_sample_and_empty(spark, taught):
    docs, labels = taught
    small = train(docs, labels, sample=200)
    assert auc([r.score for r in score(docs.where("doc_id < 800").drop("score"), small).orderBy("doc_id").collect()], [int(i % 4 == 0) for i in range(800)]) > 0.8
    nothing = train(docs.limit(0), labels)
    assert {round(r.p, 6) for r in score(docs, nothing, made="p").collect()} == {0.0}
    assert score(docs.limit(0), small, made="p").count() == 0


def test_one_class():
    bias, w = fit([np.array([0])] * 3, [None] * 3, np.ones(3), 1, penalty=1, ridge=0)
    assert bias > 10 and not w.any()


def test_swaps_are_permutations():
    assert sorted(SWAPS) == sorted(SWAPS.values()) and all(a != b for a, b in SWAPS.items())


def test_query_held_out(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, folder).collect()
    assert len(rows) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    insult = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").where("text rlike '(?i)\\\\b(idiot|moron|scum|worthless|pathetic)\\\\b'").collect()}
    print("auc", auc([r.score for r in held], [labels[r.doc_id] for r in held]))
    assert auc([r.score for r in held], [labels[r.doc_id] for r in held]) > 0.75
    assert np.mean([r.predicted for r in rows if r.doc_id in insult]) > 0.9
    assert np.mean([r.predicted for r in rows if r.doc_id not in insult]) < 0.05

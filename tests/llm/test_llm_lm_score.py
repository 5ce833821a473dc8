"""Counts and scores against a direct evaluation of the formula."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from warchest.llm.lm_score import pack, score_texts, unpack
from warchest.llm.queries import QUERIES


def tokens_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w] + ["</s>"]


class Plain:
    def __init__(self, texts, order, trust):
        self.order, self.trust, self.grams = order, trust, Counter()
        for t in texts:
            seq = ["<s>", *tokens_of(t)]
            for k in range(1, order + 1):
                self.grams.update(tuple(seq[i : i + k]) for i in range(len(seq) - k + 1))
        words = {g[0]: n for g, n in self.grams.items() if len(g) == 1 and g[0] != "<s>"}
        self.words, self.n, self.v = words, sum(words.values()), len(words)
        once, twice = (sum(n == k for n in words.values()) for k in (1, 2))
        self.d = once / (once + 2 * twice) if once and twice else 0.5

    def chance(self, context, w):
        if not context:
            if not self.n:
                return 1.0
            return (self.words[w] - self.d) / self.n if w in self.words else self.d * self.v / self.n
        low = self.chance(context[1:], w)
        c = self.grams[context]
        if not c:
            return low
        r = self.trust[len(context) - 1]
        return r * self.grams[context + (w,)] / c + (1 - r) * low

    def rows(self, text):
        seq = ["<s>", *tokens_of(text)]
        score = sum(math.log10(self.chance(tuple(seq[max(0, i - self.order + 1) : i]), seq[i])) for i in range(1, len(seq)))
        base = sum(math.log10((self.words.get(w, 0) + 1) / (self.n + self.v + 1)) for w in seq[1:])
        return len(seq) - 1, sum(w in self.words for w in seq[1:]), self.n, base, score


DOCS = [
    (1, "the cat sat on the mat"), (2, "The cat sat"), (3, "a dog\x0bsat on a cat"), (4, None), (5, ""), (6, "é É\x1cx the the the"), (7, "the " * 3000),
    (8, "unseen words here"), (8, "unseen words here"), (None, "the cat"), (10, "the dog sat on the mat"), (11, "cat"),
]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_formula(spark, order):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(DOCS)], "doc_id long, text string, i int").withColumn("block", F.lit("x"))
    out = score_texts(df, F.col("i") % 3 != 1, order=order, keep=["i", "doc_id"], block_bytes=60).collect()
    model = Plain([t for i, (_, t) in enumerate(DOCS) if i % 3 != 1], order, (0.35, 0.5))
    assert sorted(r.i for r in out) == list(range(len(DOCS)))
    for r in out:
        want = model.rows(DOCS[r.i][1])
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[:3] and r.doc_id == DOCS[r.i][0]
        assert (r.base_score, r.score) == pytest.approx(want[3:], abs=1e-7)


def test_probabilities_add_up():
    model = Plain([t for _, t in DOCS], 2, (0.35,))
    for context in [(), ("the",), ("never",)]:
        assert sum(model.chance(context, w) for w in [*model.words, "<unknown>"]) == pytest.approx(1)


def test_no_training_and_no_rows(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string")
    out = score_texts(df, F.lit(False)).collect()
    assert len(out) == len(DOCS) and all(r.score == r.base_score == 0 and r.n_known == 0 for r in out)
    assert score_texts(df.limit(0), F.lit(True)).count() == 0


def test_pack():
    x = np.array([0, 1, 2**63, 2**64 - 1], np.uint64)
    assert (unpack(pack(x)) == x).all() and len(unpack(pack(x[:0]))) == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    model = Plain([t for d, t in texts.items() if not held[d]], 2, (0.35,))
    rows = QUERIES["op2_lm_scoring"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        want = model.rows(texts[r.doc_id])
        assert r.held_out == held[r.doc_id] and (r.n_tokens, r.n_known, r.train_tokens) == want[:3]
        assert (r.base_score, r.score) == pytest.approx(want[3:], rel=1e-9, abs=1e-6)
    unseen = [r for r in rows if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)

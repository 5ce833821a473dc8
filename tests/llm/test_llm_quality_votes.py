"""Counts, votes and the fit against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from warchest.llm import quality_votes as qv
from warchest.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
        len(lines), len(set(words)), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)),
        len(re.findall(r"[!-/:-@\[-`{-~]", text)), text.count("!"), sum(w[-1] in ".!?" for w in words),
    )


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "Ä.", "x!", "\n", "\n", " ", "\r", "\u0085", " ", "9", "#", "a b a b a b a b", "日本"]), max_size=60))
def test_counts(parts):
    text = " ".join(parts)
    assert qv.counted(text.encode()) == slow(text)


def test_long_and_empty():
    text = "one two three\n" * 2000 + "é" * 100_000
    assert qv.counted(text.encode())[:5] == (6001, 2000 * 11 + 100_000, 0, 1999, 6000)
    assert qv.counted(None) == qv.counted(b"") == (0,) * len(qv.COUNTS)


def slow_fit(patterns, weights, rounds):
    """Expectation-maximisation document by document, classes and rules in loops."""
    names = list(qv.KINDS.values())
    classes = range(1 + len(names))
    member = []
    for p in patterns:
        start = [1.0] + [math.exp(-2 * sum(v for v, r in zip(p, qv.RULES, strict=True) if r in of)) for of in names]
        member.append([x / sum(start) for x in start])
    for _ in range(rounds):
        total = sum(weights)
        shares = [(sum(w * m[c] for w, m in zip(weights, member, strict=True)) + 1) / (total + len(classes)) for c in classes]
        votes = []
        for c in classes:
            votes.append([])
            for j in range(len(qv.RULES)):
                up = sum(w * m[c] for w, m, p in zip(weights, member, patterns, strict=True) if p[j] > 0)
                down = sum(w * m[c] for w, m, p in zip(weights, member, patterns, strict=True) if p[j] < 0)
                votes[c].append((up + 1) / (up + down + 2))
        for i, p in enumerate(patterns):
            x = [shares[c] * math.prod(g if v > 0 else 1 - g for v, g in zip(p, votes[c], strict=True) if v) for c in classes]
            member[i] = [y / sum(x) for y in x]
    return shares, votes, member


def test_fit_and_posterior(spark):
    rng = random.Random(1)
    patterns = list({tuple(rng.choice([1, 1, 1, 0, -1]) for _ in qv.RULES) for _ in range(30)})
    weights = [rng.randrange(1, 50) for _ in patterns]
    shares, votes, member = slow_fit(patterns, weights, 12)
    model = qv.maximise(np.array(patterns), np.array(weights), rounds=12, tolerance=0)
    assert np.allclose(model.shares, shares) and np.allclose(model.good_vote, votes)
    df = spark.createDataFrame([(list(p),) for p in patterns], "votes array<byte>")
    got = [r[0] for r in df.select(qv.posterior(model, df.votes)).collect()]
    assert np.allclose(got, [m[0] for m in member])
    assert np.all((model.accuracy >= 0) & (model.accuracy <= 1))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 7), (None, "", 7), (2, "plain words " * 30, 7), (2, "plain words " * 30, 7)], "doc_id long, text string, kept int")
    voted = qv.votes(qv.counts(df))
    rows = qv.judge(voted, qv.fit(voted)).collect()
    assert len(rows) == 4 and all(0 <= r.posterior <= 1 for r in rows)
    assert [r.base_failed and not r.kept for r in rows] == [True] * 4
    none = qv.votes(qv.counts(df.limit(0)))
    assert qv.judge(none, qv.fit(none)).count() == 0


def test_one_stray_vote_does_not_decide():
    n = len(qv.RULES)
    good = np.ones(n)
    stray = [np.where(np.arange(n) == j, -1, 1) for j in range(n)]
    markup = np.where([r in qv.KINDS["markup"] for r in qv.RULES], -1, 1)
    patterns = np.array([good, *stray, markup])
    model = qv.maximise(patterns, np.array([9000, *[10] * n, 800]))
    logs = np.log(model.shares) + (patterns > 0) @ np.log(model.good_vote).T + (patterns < 0) @ np.log(1 - model.good_vote).T
    posterior = np.exp(logs[:, 0] - np.logaddexp.reduce(logs, axis=1))
    assert posterior[0] > 0.99 and (posterior[1 : 1 + n] > 0.5).sum() >= n - 3 and posterior[-1] < 0.01


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op12_quality_rules"](spark, folder).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = slow(docs[r.doc_id])[:5]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [(quality[r.doc_id], r.kept) for r in rows if r.doc_id in quality and not r.base_failed]
    assert np.mean([k for q, k in judged if q]) > 0.98 and np.mean([not k for q, k in judged if not q]) > 0.85

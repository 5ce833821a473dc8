"""Held-out accuracy, and scores against sums made one n-gram at a time."""

import math
import zlib

import numpy as np

from warchest.llm.language_id import BITS, EVIDENCE, UNIT, _letters, grams, letter_table, predict, scorer, train
from warchest.llm.queries import QUERIES

LETTERS = _letters(letter_table())
SCHEMA = "doc_id long, text string, lang string, score string"


def slow_grams(text):
    """All n-grams of one text, each hashed alone."""
    padded, out = " ", []
    for c in (text or "").lower() + "\n":
        if c.isalpha():
            padded += c
        elif padded[-1] != " ":
            padded += " "
    m = (1 << 32) - 1
    o = [ord(c) for c in padded]
    for i in range(1, len(o)):
        if padded[i] != " ":
            out.append((o[i] * 2654435761 & m) >> (32 - BITS))
        two = (o[i] * 2246822519 + o[i - 1] * 3266489917) & m
        out.append(((two ^ (two >> 15)) * 668265263 & m) >> (32 - BITS))
        if i > 1 and padded[i - 1] != " ":
            three = (two + o[i - 2] * 374761393 + 1) & m
            out.append(((three ^ (three >> 13)) * 1274126177 & m) >> (32 - BITS))
    return sorted(out)


def test_grams_do_not_depend_on_neighbours():
    texts = ["Ab c", "", None, "12 --", "Éa  b!", "x" * 30, "日本 語"]
    got = {i: [] for i in range(len(texts))}
    for row, bucket in grams(texts, LETTERS):
        for r, b in zip(row.tolist(), bucket.tolist()):
            got[r].append(b)
    for i, t in enumerate(texts):
        want = slow_grams(t) if any(map(str.isalpha, t or "")) else []
        assert sorted(got[i]) == want, t


def test_small(spark):
    rows = [(i, "the cat and the dog", "en", "x") for i in range(5)] + [(i, "der hund und die katze", "de", "x") for i in range(5)]
    rows += [(90, None, "en", "x"), (91, "the the", None, "x"), (92, "", "fr", "x"), (93, "123", "xx", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = train(df)
    assert model.languages == ["de", "en"]
    probe = spark.createDataFrame([(1, "the dog", None, ""), (2, "die katze", "en", ""), (3, None, "en", ""), (4, " 12", "", ""), (4, " 12", "", ""), (None, "hund", "", "")], SCHEMA)
    got = sorted(predict(probe, model, made=("lang_pred", "sure")).collect(), key=str)
    assert [(r.doc_id, r.lang_pred) for r in got] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (4, "und"), (None, "de")]
    assert all((r.sure == 0) == (r.lang_pred == "und") and 0 <= r.sure <= 1 for r in got)
    empty = df.limit(0)
    assert [r.lang_pred for r in predict(probe, train(empty)).collect()] == ["und"] * 6
    assert predict(empty, model).count() == 0


def test_score_by_hand(spark):
    df = spark.createDataFrame([(1, "the cat", "en", ""), (2, "der hund", "de", ""), (3, "ja", "de", "")], SCHEMA)
    model = train(df, alpha=0.5)
    counts = {"en": slow_grams("the cat"), "de": slow_grams("der hund") + slow_grams("ja")}
    text = "the hat " * 40
    own, total = slow_grams(text), {}
    for lang, prior in (("de", 2 / 3), ("en", 1 / 3)):
        weight = {b: math.log((counts[lang].count(b) + 0.5) / (len(counts[lang]) + 0.5 * 2**BITS)) for b in set(own)}
        total[lang] = sum(weight[b] for b in own) * min(1, EVIDENCE / len(own)) + math.log(prior)
    want = 1 / (1 + math.exp(total["de"] - total["en"]))
    (lang,), (score,) = scorer(model)([text])
    assert lang == "en" and abs(score - want) < 1e-3
    assert model.matrix.dtype == np.int32 and abs(model.matrix[0, 0]) > UNIT


def test_long_text_is_split_into_windows(spark):
    model = train(spark.createDataFrame([(1, "the cat", "en", ""), (2, "der hund", "de", "")], SCHEMA))
    assert scorer(model)(["the cat " * 200_000])[0] == ["en"]


def test_query_held_out(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op1_language_id"](spark, folder).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98


def test_more_languages_than_a_block(spark):
    rows = [(i, f"{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{chr(945 + i // 26 % 24)}{chr(1072 + i // 600)} the same words", f"l{i:03}", "") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole, parts = train(df, block=1000), train(df, block=250)
    assert not whole.more and [len(m.languages) for m in (parts, *parts.more)] == [250, 250, 100]
    probe = df.where("doc_id % 40 = 0").unionAll(spark.createDataFrame([(-1, "", None, ""), (-2, "12", None, ""), (None, None, None, "")], SCHEMA))
    a, b = ({r.doc_id: r for r in predict(probe, m, keep=["doc_id", "score"], made=("x", "y")).collect()} for m in (whole, parts))
    assert len(a) == 18 and all(a[i].x == b[i].x and abs(a[i].y - b[i].y) < 1e-9 for i in a)
    assert {a[i].x for i in (-1, -2, None)} == {"und"} and a[40].x == "l040"


def test_query_scores_by_brute_force(spark):
    """Counts of all rows that are not held out, every n-gram made alone."""
    folder = "/root/testdata/sf0.001"
    docs = [r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in docs}
    counts, texts = {}, {}
    for r in docs:
        if not held[r.doc_id] and r.lang is not None and r.text is not None:
            table = counts.setdefault(r.lang, np.zeros(2**BITS))
            np.add.at(table, slow_grams(r.text), 1)
            texts[r.lang] = texts.get(r.lang, 0) + 1
    langs = sorted(counts)
    logs = np.array([np.log((counts[x] + 0.5) / (counts[x].sum() + 0.5 * 2**BITS)) for x in langs])
    prior = np.log(np.array([texts[x] for x in langs]) / sum(texts.values()))
    for r in QUERIES["op1_language_id"](spark, folder).collect():
        text = next(d.text for d in docs if d.doc_id == r.doc_id)
        if not any(map(str.isalpha, text or "")):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        own = slow_grams(text)
        evidence = logs[:, own].sum(1) * min(1, EVIDENCE / len(own)) + prior
        odds = np.exp(evidence - evidence.max())
        assert r.lang_pred == langs[int(odds.argmax())] and abs(r.score - 1 / odds.sum()) < 1e-3

"""Counts against the tokenizer library itself."""

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from warchest.llm.queries import QUERIES
from warchest.llm.token_counts import count_tokens, counter, prove_whole

FILE = public_tokenizers.path("word_bpe_49k.json")
DEFINITION = open(FILE, encoding="utf-8").read()
LIBRARY = Tokenizer.from_str(DEFINITION)
WORK = counter(DEFINITION, prove_whole(DEFINITION), remembered=50)
HARD = [
    None, "", " ", "\n\t", "it's they'll I'D ''s 'tis", "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "<|ENDOFTEXT|>",
    "ΟΔΟΣ Σ", "İstanbul ſ ŉ Ǆ", "é É É", "日本語 12½³", " x y\x1cz\x85", "Ⅷ ٣ ́a", "don’t 😀😀!?", "x" * 5000, "﻿​word",
]


def want(text):
    text = text or ""
    return len(text.encode()), len(LIBRARY.encode(text, add_special_tokens=False).ids)


def test_hard_texts():
    got = list(zip(*WORK(HARD)))
    assert got == [want(t) for t in HARD]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=8))
def test_any_text(texts):
    assert list(zip(*WORK(texts))) == [want(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F), max_size=60), max_size=8))
def test_latin_text(texts):
    assert list(zip(*WORK(texts))) == [want(t) for t in texts]


def test_every_character():
    step = 64
    texts = ["".join(f"a{chr(c)}b {chr(c)}" for c in range(k, k + step) if not 0xD800 <= c < 0xE000) for k in range(0, 0x3000, step)]
    assert list(zip(*WORK(texts))) == [want(t) for t in texts]


def test_every_character_below_u0250_in_its_surroundings():
    """Capitals whose small letter lies beyond U+0250 among them."""
    for around in ("{}", "{0}{0}", "\u00c2{}", "a{}b", " the {} 12{}x ", "{}\u00e9'{}s"):
        texts = [around.replace("{0}", "{}").replace("{}", chr(c)) for c in range(0x250)]
        assert list(zip(*WORK(texts))) == [want(t) for t in texts], around


def test_operator_rows(spark):
    df = spark.createDataFrame([(1, "the cat", 5), (1, "the cat", 5), (None, None, 6)], "doc_id long, text string, n_tokens_ long")
    rows = sorted(map(tuple, count_tokens(df, FILE).collect()), key=str)
    assert rows == [(1, 7, 2), (1, 7, 2), (None, 0, 0)]
    assert count_tokens(df.limit(0), FILE).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_token_counts"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == want(texts[r.doc_id])
        assert r.over_limit == (r.n_tokens > 2048)

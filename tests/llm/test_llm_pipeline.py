"""Every stage on its own input, against plain versions."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from test_llm_decontaminate import naive
from test_llm_mixing import slow_fill
from test_llm_sharding import places
from test_llm_near_copies import slow_classes
from warchest.llm.decontaminate import words_of
from warchest.llm.mixing import by_turns

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    """The given documents with odd rows."""
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*COLUMNS)
    some = given.where("doc_id = 5").first()
    leak = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    odd = [
        (9001, None, "en", "src1", 0), (9002, "", None, None, 0), (9003, "123 --- 456", "en", "src0", None), (None, some.text, None, None, None),
        (9004, some.text, "en", "src0", 1), (9005, "the " * 40_000, "en", "src2", 1), (None, "the only one of its kind without an id", "en", "src3", 1),
        (9006, "and " + leak.upper() + " the", "en", "src4", 1), tuple(some), (9007, "one two three four five", None, None, 1),
    ]
    return given.unionAll(spark.createDataFrame(odd, given.schema)).cache()


def rows_of(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_language(spark, docs):
    kept, given = rows_of(STAGES["language"](spark, docs, SF_DIR)), rows_of(docs)
    gone = given - kept
    assert not kept - given
    assert {r[0] for r in gone} == {9001, 9002, 9003}


def test_near_duplicates(spark, docs):
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.text or ""))
    classes = slow_classes([r.text for r in rows])
    want = Counter(tuple(rows[i]) for i in sorted(set(classes)))  # the smallest id, missing ids last
    got = rows_of(STAGES["near_duplicates"](spark, docs, SF_DIR))
    assert {r[:2] for r in got} == {r[:2] for r in want} and sum(got.values()) == sum(want.values())


def test_near_duplicates_come_from_the_operator(spark, monkeypatch):
    asked, operator = [], corpus_pipeline.near_copies
    monkeypatch.setattr(corpus_pipeline, "near_copies", lambda *a, **k: asked.append(k) or operator(*a, **k))
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (1, "an unrelated text of one id that repeats"), (2, " ".join([*words, "more"])), (1, " ".join(words)), (None, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in STAGES["near_duplicates"](spark, docs, SF_DIR).collect())
    assert got == sorted(rows[:2]) and len(asked) == 1


def test_decontamination(spark, docs):
    number = {}
    ids = lambda t: [number.setdefault(w, len(number) + 1) for w in words_of((t or "").encode())]
    items = [ids(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    seeds = [{tuple(v[k : k + 5]) for k in range(len(v) - 4)} for v in items]
    want = Counter()
    for r in docs.collect():
        own = ids(r.text)
        runs = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        bad = False
        for v, s in zip(items, seeds):
            if len(s & runs) * 5 >= len(v) / 2:
                near = {k + x for k in range(len(own)) if tuple(own[k : k + 5]) in s for x in range(5)}
                short = [own[k] if k in near else 0 for k in range(min(near), max(near) + 1)]
                bad |= sum(t[2] for t in naive(v, short, 5)) >= len(v) / 2
        if not bad:
            want[tuple(r)] += 1
    got = rows_of(STAGES["decontamination"](spark, docs, SF_DIR))
    assert got == want and 9006 not in {r[0] for r in got}


def test_mixture(spark, docs):
    given, got = docs.collect(), STAGES["mixture"](spark, docs, SF_DIR).collect()
    size, taken, copies = defaultdict(int), defaultdict(int), Counter()
    for r in given:
        size[r.source] += len((r.text or "").split())
    for r in got:
        taken[r.source] += len(r.text.split())
        copies[r.doc_id, r.source] += 1
        assert r.n_chars == len(r.text)
    names = sorted((s for s in size if s), key=str) + [None]
    want = slow_fill([size[s] for s in names], [by_turns(i) for i in range(len(names))], 3.0)
    for s, target in zip(names, want):
        assert abs(taken[s] - target) <= 1
    times = Counter((r.doc_id, r.source) for r in given)
    assert all(n <= 3 * times[k] for k, n in copies.items())


def test_shards(spark, docs):
    out = STAGES["shards"](spark, docs, SF_DIR)
    assert out.columns == [*COLUMNS, "shard", "slot"] and rows_of(out) == rows_of(docs)
    places(out.collect(), 8)


def test_empty(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_other_columns_stay(spark, docs):
    more = docs.select("*", docs["doc_id"].alias("score"), docs["text"].alias("component_id"), docs["lang"].alias("fp"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, more, SF_DIR).columns == more.columns, name
    own = more.withColumn("shard", more["doc_id"]).withColumn("slot", more["text"])
    assert STAGES["shards"](spark, own, SF_DIR).columns == [*more.columns, "shard", "slot"]


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    places(rows, 8)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert sorted(map(str, rows)) == sorted(map(str, docs.collect()))


def test_unique_texts_of_a_repeated_id_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, c), (1, c), (2, a), (2, b + " z"), (3, c.upper())]
    df = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id, r.text) for r in STAGES["near_duplicates"](spark, df, SF_DIR).collect())
    assert kept == [(1, a), (1, b), (1, c)]

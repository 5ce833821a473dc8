import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from warchest.llm.queries import QUERIES
from warchest.llm.sharding import permute, shard_documents, shard_rows, unpermute, write_shards


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 65, 1000])
def test_permutation_and_inverse(spark, n):
    df = spark.range(n).select("id", permute(F.col("id"), n, 7).alias("p")).withColumn("back", unpermute(F.col("p"), n, 7))
    rows = df.collect()
    assert sorted(r.p for r in rows) == list(range(n))
    assert all(r.back == r.id for r in rows)
    if n == 1000:
        other = [r.p for r in spark.range(n).select(permute(F.col("id"), n, 8).alias("p")).collect()]
        assert sum(a.p == b for a, b in zip(rows, other)) < 20
        assert sum(r.p == r.id for r in rows) < 20


def places(rows, shards):
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1


def test_rows(spark):
    data = [(i, f"text {i}", 1) for i in range(50)] + [(None, None, 2), (None, "", 3), (7, "text 7", 1), (7, "text 7", 1), (None, "x", 1)] + [(None, "hot", 1)] * 30
    df = spark.createDataFrame(data, "doc_id long, text string, shard int")
    rows = shard_rows(df, 4).collect()
    places(rows, 4)
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in data)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    again = shard_rows(df.repartition(5), 4).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert shard_rows(df.limit(0), 4).count() == 0


def test_documents_keep_their_columns(spark, tmp_path):
    data = [(i % 20, f"t{i % 20}", i % 3) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string, size int")
    out = shard_documents(df, 8)
    assert out.columns == ["doc_id", "text", "size", "shard", "slot"]
    rows = out.collect()
    places(rows, 8)
    assert Counter((r.doc_id, r.text, r.size) for r in rows) == Counter(data)
    assert sorted((r.shard, r.slot) for r in rows) == sorted((r.shard, r.slot) for r in shard_rows(df, 8).collect())
    write_shards(out, str(tmp_path / "shards"), 2)
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "shards")).select(out.columns).collect())) == sorted(map(str, rows))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op10_sharding"](spark, folder).collect()
    places(rows, 8)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)


def test_own_columns_shard_and_slot_are_replaced(spark):
    df = spark.createDataFrame([(i, f"t{i}", "x", 1.5) for i in range(20)], "doc_id long, text string, shard string, Slot double")
    out = shard_documents(df, 4)
    assert out.columns == ["doc_id", "text", "shard", "slot"] and dict(out.dtypes)["shard"] == "int"
    places(out.collect(), 4)


def plain_permutation(x, n, seed=0):
    """The Feistel network and its walk, a number at a time, xxhash64 from Spark's definition."""
    import xxhash

    def mixed(key, half, mask):
        inner = xxhash.xxh64(key.to_bytes(8, "little", signed=True), seed=42).intdigest()
        return xxhash.xxh64(half.to_bytes(8, "little", signed=True), seed=inner).intdigest() & mask

    bits = max(2, (n - 1).bit_length())
    left, right = bits // 2, bits - bits // 2
    while True:
        a, b = x >> right, x & (1 << right) - 1
        for i in range(8):
            a, b = b, a ^ mixed((seed << 8) + i, b, (1 << (right if i % 2 else left)) - 1)
        x = (a << right) + b
        if x < n:
            return x


def test_query_values(spark):
    """Every place of the query follows from its row number by the plain network."""
    from warchest.llm.sharding import shard_rows
    folder = "/root/testdata/sf0.001"
    rows = shard_rows(spark.read.parquet(f"{folder}/documents.parquet"), 8).collect()
    n = len(rows)
    assert sorted(r.row_number for r in rows) == list(range(n))
    place = {(r.doc_id, r.text_crc32): (r.shard, r.slot) for r in rows}
    for r in rows:
        p = plain_permutation(r.row_number, n)
        assert (r.shard, r.slot) == (p % 8, p // 8)
    for r in QUERIES["op10_sharding"](spark, folder).collect():
        assert place[r.doc_id, r.text_crc32] == (r.shard, r.slot)


def test_long_text(spark):
    df = spark.createDataFrame([(1, "\u00e9" * 3_000_000), (2, None)], "doc_id long, text string")
    out = {r.doc_id: r for r in shard_documents(df, 2).collect()}
    assert len(out[1].text) == 3_000_000 and {out[1].shard, out[2].shard} == {0, 1}

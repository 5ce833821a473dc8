import os

import pyarrow as pa

from warchest.llm import common


def test_spool_and_release(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a long, b string")
    kept = common.spool(df, "test")
    path = common.SPOOLED[-1]
    assert sorted(map(tuple, kept.collect())) == [(1, None), (2, "x")] and os.path.isdir(path)
    assert common.spool(df.limit(0), "test").count() == 0
    common.release(spark)
    assert not os.path.exists(path) and not common.SPOOLED


def test_slices():
    batch = pa.RecordBatch.from_pydict({"t": ["aa", None, "b" * 9, "c", "", "dd"], "i": list(range(6))})
    parts = [p.column(1).to_pylist() for p in common.slices(batch, 0, 3)]
    assert parts == [[0, 1], [2], [3, 4, 5]] and list(common.slices(batch.slice(0, 0), 0, 3)) == []


def test_fold(spark):
    df = spark.createDataFrame([(0,), (7,), (None,)], "i long")
    from zlib import crc32
    got = [r[0] for r in df.select(common.fold(df["i"], 5, crc32(b"0") % 5)).collect()]
    assert got[0] and got[2] is False and got[1] == (crc32(b"7") % 5 == crc32(b"0") % 5)


def test_tidy_keeps_what_is_read(spark):
    df = spark.range(5).toDF("a")
    before = len(common.SPOOLED)
    one, two = common.spool(df, "one"), common.spool(df, "two")
    paths = common.SPOOLED[before:]
    common.tidy(spark, before, two.where("a > 1"), None)
    assert [os.path.isdir(p) for p in paths] == [False, True] and two.count() == 5 and common.SPOOLED[before:] == paths[1:]
    common.tidy(spark, before)
    assert not os.path.isdir(paths[1]) and one is not None


def test_tidy_with_another_form_of_the_address(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_dir", lambda _: f"file://{tmp_path}")
    before = len(common.SPOOLED)
    one = common.spool(spark.range(3).toDF("a"), "one")
    common.tidy(spark, before, one)
    assert one.count() == 3 and len(common.SPOOLED) == before + 1
    common.tidy(spark, before)
    assert not os.listdir(tmp_path)

"""File-arrival ingest: increments, replay, late files, files delivered again or taken away."""

import os
import time

import pytest

from warchest.sources import tables
from warchest.specs import SPECS
from warchest.streaming import arrivals
from warchest.streaming.ingest import cycle_ingest

SPEC = SPECS["expenditures_by_state"]


def _line(i, state="CA", amount="10.00"):
    values = {"cmte_id": "C1", "amndt_ind": "N", "transaction_dt": "01152020", "transaction_amt": amount,
              "sub_id": str(i), "state": state}
    return "|".join(values.get(c, "") for c in SPEC.columns) + "\n"


def test_ingest(spark, tmp_path):
    landing = tmp_path / "landing"
    (landing / "a").mkdir(parents=True)
    (landing / "b").mkdir()
    table = str(tmp_path / "table")

    def run(state):
        cycle_ingest(spark, str(landing), SPEC, table, str(tmp_path / state)).awaitTermination()
        return sorted((r.election_cycle, r.state, float(r.total_amount), r.transaction_count)
                      for r in tables.read_table(spark, table).collect())

    (landing / "a" / "2020_oppexp20.txt").write_text(_line(1) + _line(2))
    (landing / "a" / "2018_oppexp18.txt").write_text(_line(1, "NY"))
    assert run("s1") == [(2018, "NY", 10.0, 1), (2020, "CA", 20.0, 2)]
    # A late file rebuilds its cycle from everything landed; a repeated id counts once.
    (landing / "b" / "2020_oppexp20.txt").write_text(_line(2) + _line(3, "TX"))
    expected = [(2018, "NY", 10.0, 1), (2020, "CA", 20.0, 2), (2020, "TX", 10.0, 1)]
    assert run("s1") == expected
    assert run("s1") == expected  # nothing new
    assert run("s2") == expected  # a fresh checkpoint replays all files


def _totals(spark, table):
    return sorted((r.election_cycle, r.state, float(r.total_amount)) for r in tables.read_table(spark, table).collect())


def test_delivered_again(spark, tmp_path):
    """The same checkpoint throughout."""
    landing, table, state = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "state")
    landing.mkdir()
    old, new = landing / "2018_oppexp18.txt", landing / "2020_oppexp20.txt"
    run = lambda: (cycle_ingest(spark, str(landing), SPEC, table, state).awaitTermination(), _totals(spark, table))[1]
    old.write_text(_line(1, "NY"))
    new.write_text(_line(1))
    assert run() == [(2018, "NY", 10.0), (2020, "CA", 10.0)]
    new.write_text(_line(1) + _line(2) + _line(3, "TX"))  # other length
    assert run() == [(2018, "NY", 10.0), (2020, "CA", 20.0), (2020, "TX", 10.0)]
    new.write_text(_line(1) + _line(2) + _line(3, "WA"))  # other time, same length
    os.utime(new, (time.time() + 5,) * 2)
    assert run() == run() == [(2018, "NY", 10.0), (2020, "CA", 20.0), (2020, "WA", 10.0)]
    before = tables.VersionedTable(spark, table).current().number
    run()
    assert tables.VersionedTable(spark, table).current().number == before  # nothing new, nothing written
    old.unlink()
    assert run() == [(2020, "CA", 20.0), (2020, "WA", 10.0)]
    old.write_text(_line(1, "NY"))  # back again
    assert run() == [(2018, "NY", 10.0), (2020, "CA", 20.0), (2020, "WA", 10.0)]


def test_replay_of_a_batch(spark, tmp_path, monkeypatch):
    """A batch that fails after its tables are written is done again from the same versions."""
    from warchest.streaming import ingest
    landing, table, state = tmp_path / "landing", str(tmp_path / "table"), str(tmp_path / "state")
    landing.mkdir()
    (landing / "2020_oppexp20.txt").write_text(_line(1))
    kept = ingest.store_cycles
    monkeypatch.setattr(ingest, "store_cycles", lambda *args: (kept(*args), 1 / 0))
    with pytest.raises(Exception):
        cycle_ingest(spark, str(landing), SPEC, table, state).awaitTermination()
    monkeypatch.setattr(ingest, "store_cycles", kept)
    cycle_ingest(spark, str(landing), SPEC, table, state).awaitTermination()
    assert _totals(spark, table) == [(2020, "CA", 10.0)]


def test_differences(spark):
    known = spark.createDataFrame([("a", "t1", 1, 1, "new file"), ("b", "t1", 1, 1, "new file"), ("b", "t2", 2, 2, "last-modified changed"),
                                   ("c", "t1", 1, 1, "new file"), ("d", None, None, 2, "gone"), ("e", None, None, 2, "gone")], arrivals.LOG_SCHEMA)
    listed = spark.createDataFrame([("a", "t1", 5), ("b", "t2", 2), ("d", "t1", 1), ("f", "t9", 0)], "path string, last_modified string, content_length bigint")
    found = sorted((r.path, r.version, r.reason) for r in arrivals.differences(known, listed).collect())
    assert found == [("a", 2, "content-length changed"), ("c", 2, "gone"), ("d", 3, "new file"), ("f", 1, "new file")]


def test_watch(spark, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    landing.mkdir()
    (landing / "2020_oppexp20.txt").write_text(_line(1))
    query = cycle_ingest(spark, str(landing), SPEC, table, str(tmp_path / "state"), available_now=False, seconds=1)

    def wait(want):
        for _ in range(100):
            if tables.read_table_or_none(spark, table) is not None and _totals(spark, table) == want:
                return True
            time.sleep(0.5)
        return False

    try:
        assert wait([(2020, "CA", 10.0)])
        (landing / "2020_oppexp20.txt").write_text(_line(1) + _line(2, "TX"))
        assert wait([(2020, "CA", 10.0), (2020, "TX", 10.0)])
    finally:
        query.stop()

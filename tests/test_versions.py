"""A stop between any two steps leaves the old or the new table, and the next write cleans up."""

import json
import os

import pytest

from warchest.sources import tables, versions


class Killed(BaseException):
    """As a lost driver: no handler of the library runs."""


def rows(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path).collect())


def frame(spark, values):
    return spark.createDataFrame(values, "election_cycle int, v int")


OLD, NEW = [(1, 2018), (2, 2020), (3, 2022)], [(1, 2018), (20, 2020), (30, 2022)]
STEPS = ["staged", "backup named", "published", "versions swept"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("kind", ["whole", "cycles", "one"])
def test_stop_between_steps(spark, tmp_path, monkeypatch, kind, step):
    path = str(tmp_path / "t")
    changed = frame(spark, [(2020, 20), (2022, 30)])

    def write():
        if kind == "whole":
            tables.write_table(frame(spark, [(2018, 1), (2020, 20), (2022, 30)]), path, backup=True)
        elif kind == "cycles":
            tables.replace_cycles(changed, path, touched=[2020, 2022])
        else:
            tables.replace_cycle(changed, path, 2020)

    first = frame(spark, [(2018, 1), (2020, 2), (2022, 3)])
    tables.write_table(first, path) if kind == "whole" else tables.write_partitioned(first, path)
    old = rows(spark, path)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "reached", lambda s: (_ for _ in ()).throw(Killed) if s == step else None)
        if step == "backup named" and kind != "whole":
            write()
        else:
            with pytest.raises(Killed):
                write()
    seen = rows(spark, path)
    write()
    new = rows(spark, path)
    assert new != old and seen in (old, new)
    assert seen == (new if step in ("published", "versions swept") or (step == "backup named" and kind != "whole") else old)
    if kind == "whole":
        assert rows(spark, f"{path}.bak") in (old, new)
    write()  # afterwards only what the last two pointers (and the backup) name is left
    live = {f for p in versions.VersionedTable(spark, path).pointers(2) for f in p.folders.values()}
    live |= {f for p in versions.VersionedTable(spark, f"{path}.bak").pointers() for f in p.folders.values()}
    on_disk = {f"{path}/{n}" for n in os.listdir(path) if not n.startswith("_")}
    assert on_disk == {f if "/election_cycle=" not in f else f.rpartition("/")[0] for f in live}
    assert len(os.listdir(f"{path}/_pointers")) <= 2 * versions.KEPT  # with checksum files


def test_broken_pointer_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(2018, 1)]), path)
    (tmp_path / "t" / "_pointers" / "0000000002.json").write_text('{"folders": {"": "/no')
    assert rows(spark, path) == [(2018, 1)]
    tables.write_table(frame(spark, [(2018, 2)]), path)
    assert rows(spark, path) == [(2018, 2)] and versions.VersionedTable(spark, path).current().number == 3


def test_two_writers(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(frame(spark, [(2018, 1), (2020, 2)]), path)
    table = versions.VersionedTable(spark, path)
    before = table.current()
    late = table.stage(frame(spark, [(2020, 5)]), "election_cycle")
    folders = {**before.folders, **late.folders()}
    tables.replace_cycle(frame(spark, [(2018, 7)]), path, 2018)
    with pytest.raises(versions.PublishConflict):
        table.publish(late.schema, folders, before)
    assert rows(spark, path) == [(2, 2020), (7, 2018)]


def test_first_version_in_flight(spark, tmp_path):
    path = str(tmp_path / "t")
    staged = tables.stage_table(frame(spark, [(2018, 1)]), path)
    assert tables.read_table_or_none(spark, path) is None and staged.read().count() == 1
    with pytest.raises(versions.NotPublished):
        tables.read_table(spark, path)
    staged.publish()
    assert rows(spark, path) == [(2018, 1)]


def test_a_reader_can_end(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(frame(spark, [(2018, 1)]), path)
    reading = tables.read_table(spark, path)
    tables.write_table(frame(spark, [(2018, 2)]), path)
    assert [r.v for r in reading.collect()] == [1]


def test_empty_and_plain(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    tables.write_partitioned(frame(spark, []), path)
    assert rows(spark, path) == [] and tables.read_table(spark, path).columns == ["v", "election_cycle"]
    tables.replace_cycles(frame(spark, [(None, 4), (2020, 5)]), path)
    assert {r.v: r.election_cycle for r in tables.read_table(spark, path).collect()} == {4: None, 5: 2020}
    frame(spark, [(2020, 1)]).write.partitionBy("election_cycle").parquet(plain)
    assert rows(spark, plain) == [(1, 2020)]
    with pytest.raises(ValueError, match="no pointer"):
        tables.replace_cycle(frame(spark, [(2020, 2)]), plain, 2020)
    tables.write_partitioned(frame(spark, [(2020, 3)]), plain)
    assert rows(spark, plain) == [(3, 2020)] and not os.path.exists(f"{plain}/election_cycle=2020")
    assert json.loads((tmp_path / "plain" / "_pointers" / "0000000001.json").read_text())["folders"].keys() == {"election_cycle=2020"}
    assert "election_cycle" in str(tables.read_table(spark, plain).where("election_cycle = 2020")._jdf.queryExecution().executedPlan()).split("PartitionFilters")[1]

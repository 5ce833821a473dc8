"""Reporting tables are audited before they are published."""

import pytest
from pyspark.sql import functions as F

from warchest.plans import jobs
from warchest.sources import catalog, tables
from warchest.sources.versions import VersionedTable

NAME = "fec_committees"
COLUMNS = ["cmte_id", "election_cycle", "cmte_nm", "cmte_tp", "cmte_dsgn", "cmte_pty_affiliation", "connected_org_nm", "cand_id"]


def committees(spark, *rows):
    made = [(i, c, n, None, None, None, None, None) for i, c, n in rows]
    return spark.createDataFrame(made, ", ".join(f"{c} {'int' if c == 'election_cycle' else 'string'}" for c in COLUMNS))


def stored(spark, path):
    return sorted((r.cmte_id, r.year, r.cmte_nm) for r in tables.read_table(spark, path).collect())


def rejected(spark, path):
    return sorted((str(r.cmte_id), r.cmte_nm, ",".join(r.reasons)) for r in tables.read_table(spark, f"{path}.rejected").collect())


GOOD = [("C1", 2020, "a"), ("C2", 2020, "b")]
BAD = [("C1", 2020, "z"), ("C1", 2020, "y"), ("C1", 2020, "x"), (None, 2020, "n"), (None, 2020, "n"), ("C3", 2020, "c")]


def test_hold(spark, tmp_path):
    path = str(tmp_path / NAME)
    assert catalog.load_table(committees(spark, *GOOD), NAME, path) == catalog.Load(NAME, True, 2, 0)
    assert catalog.load_table(committees(spark, *BAD), NAME, path) == catalog.Load(NAME, False, 0, 5)
    assert stored(spark, path) == [("C1", 2020, "a"), ("C2", 2020, "b")]
    assert rejected(spark, path) == [("C1", x, "repeated key") for x in "xyz"] + [("None", "n", "missing cmte_id")] * 2
    # mended, it is published, and nothing is rejected any more
    catalog.load_table(committees(spark, ("C9", 2020, "q")), NAME, path)
    assert stored(spark, path) == [("C9", 2020, "q")] and rejected(spark, path) == []


def test_first_load_held_leaves_no_table(spark, tmp_path):
    path = str(tmp_path / NAME)
    assert not catalog.load_table(committees(spark, *BAD), NAME, path).published
    assert tables.read_table_or_none(spark, path) is None and len(rejected(spark, path)) == 5


def test_divert_and_report(spark, tmp_path):
    path = str(tmp_path / NAME)
    assert catalog.load_table(committees(spark, *BAD), NAME, path, on_violation="divert") == catalog.Load(NAME, True, 2, 4)
    assert stored(spark, path) == [("C1", 2020, "x"), ("C3", 2020, "c")]
    assert rejected(spark, path) == [("C1", "y", "repeated key"), ("C1", "z", "repeated key"), ("None", "n", "missing cmte_id"), ("None", "n", "missing cmte_id")]
    assert catalog.load_table(committees(spark, *BAD), NAME, path, on_violation="report").rows == 6
    assert tables.read_table(spark, path).count() == 6 and tables.read_table(spark, path).columns[:2] == ["cmte_id", "year"]
    with pytest.raises(ValueError):
        catalog.load_table(committees(spark), NAME, path, on_violation="ignore")


def test_required_and_unreadable(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [("2020", "2020", "C1", "CA", "5.5", "1"), ("2020", None, "C1", "CA", "x", "2"), ("20x0", "2020", None, "CA", " ", "")],
        "election_cycle string, transaction_year string, cmte_id string, state string, total_amount string, transaction_count string")
    catalog.load_table(df, "fec_expenditures_by_state", path, on_violation="divert")
    assert [tuple(r) for r in tables.read_table(spark, path).collect()] == [(2020, 2020, "C1", "CA", 5.5, 1)]
    assert sorted(tuple(r.reasons) for r in tables.read_table(spark, f"{path}.rejected").collect()) == [
        ("unreadable election_cycle", "missing election_cycle", "missing cmte_id"), ("unreadable total_amount", "missing transaction_year")]
    found = catalog.rejected_rows(spark, str(tmp_path))
    assert found.count() == 0 and found.columns == ["table_name", "reason", "row"]


def test_empty_and_failed(spark, tmp_path):
    path = str(tmp_path / NAME)
    assert catalog.load_table(committees(spark), NAME, path) == catalog.Load(NAME, True, 0, 0)
    assert stored(spark, path) == []
    late = committees(spark, *GOOD).repartition(2).withColumn("cmte_nm", F.when(F.col("cmte_id") == "C2", F.raise_error(F.lit("late"))).otherwise("q"))
    before = VersionedTable(spark, path).current()
    with pytest.raises(Exception, match="late"):
        catalog.load_table(late, NAME, path)
    assert VersionedTable(spark, path).current() == before
    assert [p.name for p in (tmp_path / NAME).iterdir() if p.name.startswith("version=")] == [
        f.rpartition("/version=")[2].split("/")[0] for f in before.folders.values()]


def test_job_lists_keys_and_rows(spark, tmp_path):
    root, target = str(tmp_path / "root"), str(tmp_path / "target")
    tables.write_table(committees(spark, *BAD), f"{root}/committee_registrations")
    keys = jobs.load_report_tables(spark, root, target).collect()
    assert sorted((r.key, r.row_count) for r in keys) == [('{"cmte_id":"C1","year":2020}', 3), ('{"year":2020}', 2)]
    assert tables.read_table_or_none(spark, f"{target}/{NAME}") is None
    assert sorted({(r.table_name, r.reason) for r in catalog.rejected_rows(spark, target).collect()}) == [(NAME, "missing cmte_id"), (NAME, "repeated key")]

"""Typed rows and rejected lines of one scan."""

from pyspark.sql import types as T

from warchest.sources import files, lines, tables
from warchest.specs import SPECS, DatasetSpec

SPEC = DatasetSpec("x", "xx", 2000, ("a", "transaction_amt", "c"))


def rejected(spark, stored):
    return sorted((r.file.rpartition("/")[2], r.line_number, r.election_cycle, tuple(r.reasons), r.line) for r in tables.read_table(spark, stored.rejected).collect())


def test_places_and_reasons(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "2020_xx20.txt").write_text('\na|1|c\nb|1\n\n"q|2.5|d|e\nz|2x|\n  \nlast||"\n')
    (landing / "2018_xx18.txt").write_text("ok|3|c\nbad|y\n")
    stored = lines.store(spark, str(landing), SPEC, str(tmp_path / "t"))
    assert rejected(spark, stored) == [
        ("2018_xx18.txt", 2, 2018, ("too few fields", "unreadable transaction_amt"), "bad|y"),
        ("2020_xx20.txt", 3, 2020, ("too few fields",), "b|1"), ("2020_xx20.txt", 5, 2020, ("too many fields",), '"q|2.5|d|e'),
        ("2020_xx20.txt", 6, 2020, ("unreadable transaction_amt",), "z|2x|")]
    rows = tables.read_table(spark, stored.rows)
    assert rows.columns == ["election_cycle", "a", "transaction_amt", "c"]
    assert sorted((r.a, r.transaction_amt and float(r.transaction_amt), r.c) for r in rows.collect()) == [("a", 1.0, "c"), ("last", None, '"'), ("ok", 3.0, "c")]
    lenient = lines.store(spark, str(landing), SPEC, str(tmp_path / "u"), faults=("numbers",))
    assert [r[1] for r in rejected(spark, lenient)] == [2, 6]
    # what is not rejected is what the plain reader gives
    plain = files.read_pipe(spark, str(landing), SPEC.raw_schema, "*.txt")
    kept = tables.read_table(spark, lines.store(spark, str(landing), SPEC, str(tmp_path / "v"), faults=()).rows)
    assert sorted(map(str, plain.collect())) == sorted(map(str, kept.collect()))


def test_line_numbers_across_blocks(spark, tmp_path):
    """A file of many blocks, several of them in one task."""
    landing = tmp_path / "landing"
    landing.mkdir()
    text = [f"row{i}|{i}|c" if i % 97 else f"bad{i}" for i in range(1, 5001)]
    for cycle in (2018, 2020):
        (landing / f"{cycle}_xx{cycle % 100}.txt").write_text("\n".join(text) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        stored = lines.store(spark, str(landing), SPEC, str(tmp_path / "t"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = rejected(spark, stored)
    assert [(c, n, v) for _, n, c, _, v in got] == [(c, i, f"bad{i}") for c in (2018, 2020) for i in range(97, 5001, 97)]
    assert tables.read_table(spark, stored.rows).count() == 2 * (5000 - 51)


def test_one_scan(spark, tmp_path):
    (tmp_path / "2020_xx20.txt").write_text("a|1|c\n")
    rows = lines.parse(lines.read_lines(spark, str(tmp_path), SPEC), SPEC.raw_schema)
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert isinstance(rows.schema["transaction_amt"].dataType, T.DecimalType)


def test_empty(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "2020_xx20.txt").write_text("")
    stored = lines.store(spark, str(landing), SPEC, str(tmp_path / "t"))
    assert tables.read_table(spark, stored.rows).count() == tables.read_table(spark, stored.rejected).count() == 0
    assert SPECS["committee_transaction_summaries"].raw_schema.names[-1] == "sub_id"

"""Raw files, sinks and tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warchest.operators import clean, crosswalk, quality
from warchest.plans import refresh
from warchest.sources import catalog, files, tables
from warchest.specs import LEGISLATOR, SPECS, schema_of

SMALL = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("amount", T.DecimalType(14, 2)), T.StructField("note", T.StringType())])


def test_pipe_edge_cases(spark, tmp_path):
    path = tmp_path / "2024_oth24.txt"
    path.write_bytes(
        b'001|12.50|said "no\n'      # stray quote is text
        b'002|7|a|extra|more\n'      # extra fields are dropped
        b'003|1\n'                   # short row
        b'004|abc|b\n'               # bad number
        b'005||\n'                   # empty fields
        b'006|2|caf\xe9 x\n'         # bad bytes
        b'"007"|3|"q"\n')
    rows = {r.id: r for r in files.read_pipe(spark, str(tmp_path), SMALL, "*.txt").collect()}
    assert rows["001"].note == 'said "no' and str(rows["001"].amount) == "12.50"
    assert rows["002"].note == "a"
    assert rows["003"].note is None
    assert rows["004"].amount is None and rows["004"].note == "b"
    assert rows["005"].amount is None and rows["005"].note is None
    assert rows["006"].note == "caf� x"
    assert rows['"007"'].note == '"q"'
    assert {r.election_cycle for r in rows.values()} == {2024}


def test_landing_names(spark, tmp_path):
    spec = SPECS["committee_transaction_summaries"]
    for name in ("2024_OTH24.TXT", "2022_oth22.txt", "2022_pas222.txt", "notes.txt"):
        (tmp_path / name).write_text("|".join(["C1"] * len(spec.columns)) + "\n")
    read = files.read_dataset(spark, str(tmp_path), spec)
    assert sorted(r[0] for r in read.select("election_cycle").collect()) == [2022, 2024]
    assert files.read_dataset(spark, str(tmp_path), spec, 2022).count() == 1


def test_external_header(spark, tmp_path):
    (tmp_path / "head.csv").write_text("CMTE_ID,Amount\n")
    (tmp_path / "2020_x20.txt").write_text("C1|5\nC2|6\n")
    df = files.read_with_headers(spark, str(tmp_path), str(tmp_path / "head.csv"), "*.txt")
    assert df.columns == ["election_cycle", "cmte_id", "amount"]
    assert sorted(tuple(r) for r in df.collect()) == [(2020, "C1", "5"), (2020, "C2", "6")]


def test_csv_round_trip(spark, tmp_path):
    rows = [('a "quoted", b', " padded "), (None, "x"), ("line", "back\\slash")]
    df = spark.createDataFrame(rows, "p string, q string")
    tables.export_csv(df, str(tmp_path / "out"))
    back = files.read_text_csv(spark, str(tmp_path / "out"), ["p", "q"])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    pruned = files.read_csv(spark, str(tmp_path / "out"), back.schema, ["q"])
    assert "ReadSchema: struct<q:string>" in pruned._jdf.queryExecution().executedPlan().toString()


def test_legislators_and_overrides(spark, tmp_path):
    (tmp_path / "m.json").write_text(
        '[{"id": {"bioguide": "A1", "fec": ["H1"]}, "name": {"last": "Lee"},'
        ' "terms": [{"type": "rep", "start": "2001-01-03", "district": 7}]}]')
    row = files.read_legislators(spark, str(tmp_path / "m.json"), multi_line=True).first()
    assert (row.id.bioguide, row.id.fec, row.terms[0].district) == ("A1", ["H1"], 7)
    (tmp_path / "o.json").write_text('{"don m payne jr": {"bioguide_id": "P2", "display_name": "D."}}')
    table = files.read_overrides(spark, str(tmp_path / "o.json"))
    people = spark.createDataFrame([("Don M. Payne, Jr.", "P1"), ("Ann Lee", None)], "n string, b string")
    got = {r.n: r.b for r in crosswalk.apply_overrides(people, table, "n", "b").collect()}
    assert got == {"Don M. Payne, Jr.": "P2", "Ann Lee": None}
    assert LEGISLATOR.fieldNames() == ["id", "name", "bio", "terms"]


def test_replace_cycle_touches_one_cycle(spark, tmp_path):
    out = str(tmp_path / "t")
    df = spark.createDataFrame([(2020, 1), (2022, 2), (2022, 3)], "election_cycle int, v int")
    tables.write_partitioned(df, out)
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "election_cycle=2020").glob("*.parquet")}
    new = spark.createDataFrame([(2022, 9), (2020, 8)], "election_cycle int, v int")
    for _ in range(2):  # repeating changes nothing
        tables.replace_cycle(new, out, 2022)
        assert sorted(map(tuple, tables.read_table(spark, out).select("election_cycle", "v").collect())) == [(2020, 1), (2022, 9)]
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t" / "election_cycle=2020").glob("*.parquet")}
    tables.replace_cycle(new.limit(0), out, 2022)
    assert [tuple(r) for r in tables.read_table(spark, out).select("election_cycle", "v").collect()] == [(2020, 1)]
    tables.replace_cycles(spark.createDataFrame([(2024, 5)], "election_cycle int, v int"), out)
    assert sorted(r[0] for r in tables.read_table(spark, out).select("election_cycle").collect()) == [2020, 2024]


def test_report_table_types(spark):
    spec = catalog.REPORT_TABLES["fec_committees"]
    source = schema_of(list(SPECS[spec.source].columns))
    df = spark.createDataFrame([], source).withColumn("election_cycle", F.lit(2020))
    out = catalog.report_table(df, spec)
    assert out.columns[:2] == ["cmte_id", "year"] and dict(out.dtypes)["year"] == "int"


def _raw_expenditure(i, memo="", amended="N", category="001"):
    spec = SPECS["expenditures_by_category"]
    values = {"cmte_id": "C1", "amndt_ind": amended, "transaction_dt": "01152020", "transaction_amt": "10.00",
              "category": category, "category_desc": "x", "memo_cd": memo, "sub_id": str(i), "state": "CA"}
    return "|".join(values.get(c, "") for c in spec.columns)


def test_refresh_applies_what_it_can(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    (landing / "2020_oppexp20.txt").write_text("\n".join(
        [_raw_expenditure(1), _raw_expenditure(1), _raw_expenditure(2, memo="X"), _raw_expenditure(3, amended="A"),
         _raw_expenditure(4, category="002")]) + "\n")
    changes = spark.createDataFrame(
        [("expenditures_by_category", 2020, "e1", None, 5), ("expenditures_by_category", 2018, "e1", None, 5),
         ("nothing", 2020, None, None, None)],
        "dataset string, cycle int, etag string, last_modified string, content_length bigint")
    manifest = f"{root}/manifest"
    dry = refresh.apply_changes(spark, changes, str(landing), root, manifest, dry_run=True)
    assert tables.read_table_or_none(spark, manifest) is None
    for result in (dry, refresh.apply_changes(spark, changes, str(landing), root, manifest)):
        status = {(r.dataset, r.cycle): r.status for r in result.collect()}
        assert status == {("expenditures_by_category", 2020): "applied", ("expenditures_by_category", 2018): "failed",
                          ("nothing", 2020): "failed"}
    states = refresh.read_manifest(spark, manifest).collect()
    assert [(s.dataset, s.cycle, s.etag, s.content_length) for s in states] == [("expenditures_by_category", 2020, "e1", 5)]
    by_state = tables.read_table(spark, f"{root}/expenditures_by_state").collect()
    assert [(r.state, float(r.total_amount), r.transaction_count) for r in by_state] == [("CA", 20.0, 2)]
    assert tables.read_table(spark, f"{root}/expenditures_by_category").count() == 2


def test_dedupe_scope_and_null_keys(spark):
    df = spark.createDataFrame(
        [(2020, "1", 5), (2020, "1", 4), (2022, "1", 3), (2020, None, 2), (2020, None, 1)],
        "election_cycle int, sub_id string, v int")
    assert sorted(r.v for r in clean.dedupe(df).collect()) == [1, 3, 4]
    # Columns decide in order, so across cycles the earliest cycle's smallest row stays.
    assert sorted(r.v for r in clean.dedupe(df, scope="global").collect()) == [1, 4]


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(100).select(
        (F.col("id") % 2).alias("election_cycle"), (F.col("id") % 3).cast("string").alias("sub_id"), F.col("id").alias("v"))
    plan = clean.dedupe(df)._jdf.queryExecution().executedPlan().toString()
    partial, shuffle = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and shuffle < partial  # plans print top down


def test_force_recomputes_year(spark):
    df = spark.createDataFrame([(2020, 1999, "01152020")], "election_cycle int, transaction_year int, transaction_dt string")
    assert clean.add_transaction_year(df).first().transaction_year == 1999
    again = clean.add_transaction_year(df, force=True)
    assert again.columns == ["election_cycle", "transaction_year", "transaction_dt"]
    assert again.first().transaction_year == 2020


def test_quality_helpers(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (200, "y")], "n int, t string")
    assert {r.column_name: r.null_rows for r in quality.required_nulls(df, ["n", "t"]).collect()} == {"n": 0, "t": 1}
    assert [r.n for r in quality.out_of_range(df, "n", 1, 100).collect()] == [200]
    many = spark.range(1234).select(F.lit(None).cast("int").alias("election_cycle"))
    assert quality.table_profile(many, "m").first().issues == ["1,234 null election_cycle values"]


@pytest.mark.parametrize("name", ["expenditures_by_state", "committee_to_candidate_summaries"])
def test_specs_name_raw_columns(name):
    spec = SPECS[name]
    assert set(spec.key_sources.values()) <= set(spec.columns)

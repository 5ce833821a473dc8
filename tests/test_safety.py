"""What must not be lost: amounts, one survivor per id, tables when a job fails, cycles that end up empty."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from warchest.operators import clean, crosswalk, quality, rollup
from warchest.plans import refresh, reports
from warchest.sources import catalog, files, tables
from warchest.specs import SPECS
from warchest.streaming.ingest import cycle_ingest

CATEGORY, STATE = SPECS["expenditures_by_category"], SPECS["expenditures_by_state"]


def line(i, state="CA", amount="10.00", **more):
    values = {"cmte_id": "C1", "amndt_ind": "N", "transaction_dt": "01152020", "transaction_amt": amount, "sub_id": str(i),
              "state": state, "category": "001", "category_desc": "x", **more}
    return "|".join(values.get(c, "") for c in CATEGORY.columns) + "\n"


def totals(df, key="state"):
    return sorted((r[key], float(r.total_amount), r.transaction_count) for r in df.collect())


def test_large_amounts_reach_the_report(spark, tmp_path):
    amounts = {"AA": "1000000000000.00", "BB": "1000000000000000.00", "CC": "-5.25", "DD": "12x", "EE": "12.345", "FF": ""}
    (tmp_path / "2020_oppexp20.txt").write_text("".join(line(i, s, a) for i, (s, a) in enumerate(amounts.items())))
    raw = files.read_dataset(spark, str(tmp_path), STATE)
    rolled = rollup.rollup(raw, STATE)
    assert totals(rolled) == [("AA", 1e12, 1), ("BB", 1e15, 1), ("CC", -5.25, 1), ("DD", 0.0, 1), ("EE", 12.35, 1), ("FF", 0.0, 1)]
    assert quality.amount_check(rolled).first().extreme_rows == 1
    audit = {r.column_name: tuple(r)[1:] for r in quality.raw_value_audit(
        files.read_raw_text(spark, str(tmp_path), STATE), STATE.raw_schema).collect()}
    assert audit["transaction_amt"] == (5, 1, 1)
    loaded = catalog.report_table(rolled, catalog.REPORT_TABLES["fec_expenditures_by_state"])
    assert dict(loaded.dtypes)["transaction_count"] == "bigint"


def test_one_survivor_everywhere(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    rows = [line(1, "CA", "9.00", category="002"), line(1, "NY", "5.00", category="001"), line(2, "TX", "1.00")]
    (landing / "2020_oppexp20.txt").write_text("".join(rows))
    raw = files.read_dataset(spark, str(landing), STATE)
    want = [("NY", 5.0, 1), ("TX", 1.0, 1)]
    assert totals(rollup.rollup(raw, STATE)) == totals(rollup.expenditure_rollups(raw)[1]) == want
    root = str(tmp_path / "tables")
    changes = spark.createDataFrame([(CATEGORY.name, 2020, None, None, 1)], "dataset string, cycle int, etag string, last_modified string, content_length bigint")
    refresh.apply_changes(spark, changes, str(landing), root, f"{root}/manifest")
    assert totals(tables.read_table(spark, f"{root}/{STATE.name}")) == want
    stream = str(tmp_path / "stream")
    cycle_ingest(spark, str(landing), CATEGORY, f"{stream}/{CATEGORY.name}", str(tmp_path / "state")).awaitTermination()
    assert totals(tables.read_table(spark, f"{stream}/{STATE.name}")) == want
    assert totals(tables.read_table(spark, f"{stream}/{CATEGORY.name}"), "category") == [("001", 6.0, 2)]


def test_redelivery_without_rows_empties_the_cycle(spark, tmp_path):
    landing, root = tmp_path / "landing", tmp_path / "tables"
    landing.mkdir()
    target = f"{root}/{CATEGORY.name}"
    (landing / "2020_oppexp20.txt").write_text(line(1, "CA", "5.00"))
    (landing / "2018_oppexp18.txt").write_text(line(1, "CA", "7.00"))
    cycle_ingest(spark, str(landing), CATEGORY, target, str(tmp_path / "s1")).awaitTermination()
    (landing / "2020_oppexp20.txt").write_text(line(1, "CA", "5.00", amndt_ind="A"))
    cycle_ingest(spark, str(landing), CATEGORY, target, str(tmp_path / "s1")).awaitTermination()  # the same checkpoint
    for name in (CATEGORY.name, STATE.name):
        assert [(r.election_cycle, float(r.total_amount)) for r in tables.read_table(spark, f"{root}/{name}").collect()] == [(2018, 7.0)]


def test_failed_job_leaves_the_table(spark, tmp_path):
    good = spark.createDataFrame([(2020, 1), (2022, 2)], "election_cycle int, v int")
    bad = good.repartition(2).withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("late failure")).cast("int")).otherwise(F.col("v")))
    plain, parted = str(tmp_path / "plain"), str(tmp_path / "parted")
    tables.write_table(good, plain)
    tables.write_partitioned(good, parted)
    for job in (lambda: tables.write_table(bad, plain), lambda: tables.write_partitioned(bad, parted),
                lambda: tables.replace_cycles(bad, parted, touched=[2020]), lambda: tables.replace_cycle(bad, parted, 2022)):
        with pytest.raises(Exception, match="late failure"):
            job()
        for path in (plain, parted):
            assert sorted((r.election_cycle, r.v) for r in tables.read_table(spark, path).collect()) == [(2020, 1), (2022, 2)]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["parted", "plain"]  # nothing staged is left
    tables.write_table(tables.read_table(spark, plain).where("v = 1"), plain, backup=True)  # reads what it replaces
    assert tables.read_table(spark, plain).count() == 1 and tables.read_table(spark, f"{plain}.bak").count() == 2


def test_only_a_missing_folder_is_none(spark, tmp_path):
    assert tables.read_table_or_none(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "half").mkdir()
    with pytest.raises(Exception):
        tables.read_table_or_none(spark, str(tmp_path / "half"))


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("election_cycle,cand_id,bioguide_id\n2024,H1,B1\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("cand_id", "bioguide_id", "note")])
    row = files.read_csv(spark, str(tmp_path / "a.csv"), schema).first()
    assert (row.cand_id, row.bioguide_id, row.note) == ("H1", "B1", None)
    assert files.read_text_csv(spark, str(tmp_path / "a.csv"), ["bioguide_id"]).first() == ("B1",)
    (tmp_path / "many").mkdir()
    (tmp_path / "many" / "a.csv").write_text("cand_id,bioguide_id\nH1,B1\n")
    (tmp_path / "many" / "b.csv").write_text("bioguide_id,cand_id\nB2,H2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, str(tmp_path / "many"), schema).collect()


def test_dry_run_counts_and_samples(spark, tmp_path):
    (tmp_path / "2020_oppexp20.txt").write_text(line(1) + line(2, category="002"))
    changes = spark.createDataFrame([(CATEGORY.name, c, None, None, 1) for c in (2020, 2018)], "dataset string, cycle int, etag string, last_modified string, content_length bigint")
    out = {r.cycle: (r.status, r.row_count) for r in refresh.apply_changes(spark, changes, str(tmp_path), str(tmp_path / "t"), str(tmp_path / "m"), dry_run=True).collect()}
    assert out == {2020: ("applied", 2), 2018: ("failed", None)} and not (tmp_path / "t").exists()
    shown = refresh.preview(spark, CATEGORY.name, [2020], str(tmp_path), sample=1).first()
    assert shown.row_count == 2 and len(shown.sample) == 1 and '"category":"001"' in shown.sample[0]


def test_widths(spark, tmp_path):
    (tmp_path / "2020_oth20.txt").write_text("a|b|c\na|b\na|b|c|d\n\na||\n")
    row = quality.width_audit(files.read_lines(spark, str(tmp_path), "*.txt"), 3).first()
    assert (row.election_cycle, row.n_lines, row.short_lines, row.long_lines) == (2020, 4, 1, 1)


def test_key_violations(spark):
    df = spark.createDataFrame([("C1", 2020), ("C1", 2020), (None, 2020), ("C2", 2020)], "cmte_id string, year int")
    assert sorted((r.key, r.row_count) for r in catalog.key_violations(df, "fec_committees").collect()) == [
        ('{"cmte_id":"C1","year":2020}', 2), ('{"year":2020}', 1)]


def test_search_with_a_backslash(spark):
    df = spark.createDataFrame([(2020, "C1", "A\\B PAC", "H"), (2020, "C2", "f\\ x", "H"), (2020, "C3", "plain", "H")],
                               "election_cycle int, cmte_id string, cmte_nm string, cmte_tp string")
    ids = lambda text: [r.cmte_id for r in reports.committee_search(df, text).collect()]
    assert ids("f\\ ") == ["C2"] and ids("\\") == ["C1", "C2"] and ids("a_b") == ["C1"] and ids("%") == ["C1", "C2", "C3"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    summaries = spark.createDataFrame([], "election_cycle int, cand_id string, cand_name string, ttl_receipts double, ttl_disb double, coh_cop double")
    given = spark.createDataFrame([], "election_cycle int, cmte_id string, cmte_name string, cand_id string, total_amount double, transaction_count bigint")
    links = spark.createDataFrame([], "cand_id string, bioguide_id string, match_method string, confidence string")
    for everybody in (reports.fundraising_over_time(summaries), reports.large_contributions(given, summaries, 5),
                      reports.committee_given(given, summaries, links)):
        assert "rangepartitioning" not in _plan(everybody)
    one = spark.range(10).selectExpr("string(id) AS cand_id", "string(id % 3) AS bioguide_id", "'m' AS match_method", "'high' AS confidence")
    assert _plan(crosswalk.crosswalk_stats(one)).count("Range (") == 1
    audit = clean.changed_values(one, {"match_method": F.upper, "confidence": F.upper})
    assert _plan(audit).count("Range (") == 1 and sorted(r.after for r in audit.collect()) == ["HIGH", "M"]


def test_first_load_is_one_plan_a_dataset(spark, tmp_path):
    for c in (2016, 2018, 2020):
        (tmp_path / f"{c}_oppexp{c % 100}.txt").write_text(line(1))
    changes = spark.createDataFrame([(CATEGORY.name, c, None, None, 1) for c in (2016, 2018, 2020)], "dataset string, cycle int, etag string, last_modified string, content_length bigint")
    calls, kept = [], refresh.refresh_cycles
    refresh.refresh_cycles = lambda spark, name, cycles, *rest: (calls.append(cycles), kept(spark, name, cycles, *rest))
    try:
        out = refresh.apply_changes(spark, changes, str(tmp_path), str(tmp_path / "t"), str(tmp_path / "m")).collect()
    finally:
        refresh.refresh_cycles = kept
    assert calls == [[2016, 2018, 2020]] and {r.status for r in out} == {"applied"}


def test_cycle_range_is_a_parameter(spark):
    from warchest.functions import term_cycles
    row = spark.range(1).select(
        term_cycles(F.lit("rep"), F.lit("2027-01-03"), F.lit("2029-01-03")).alias("now"),
        term_cycles(F.lit("rep"), F.lit("2027-01-03"), F.lit("2029-01-03"), 1980, 2030).alias("later")).first()
    assert row.now == [2026] and row.later == [2026, 2028]


def test_change_audit_is_exact(spark):
    """Against a plain pass, where changes are early, late, rare and absent."""
    df = spark.range(3000).selectExpr(
        "if(id % 7 = 0, null, concat('name ', lpad(id, 5, '0'))) AS early", "upper(concat('A', lpad(id, 5, '0'))) AS never",
        "if(id = 2999, 'zz last', concat('M', id)) AS late", "if(id % 1000 = 1, concat('q', id), concat('Ä', id)) AS rare")
    found = {(r.column_name, r.before, r.after) for r in clean.changed_values(df, dict.fromkeys(df.columns, F.upper)).collect()}
    want = set()
    for c in df.columns:
        values = sorted({r[0] for r in df.select(c).collect() if r[0] is not None and r[0].upper() != r[0]})
        want |= {(c, v, v.upper()) for v in values[:3]}
    assert found == want and len(found) == 7
    assert clean.changed_values(df.limit(0), {"early": F.upper}).count() == 0

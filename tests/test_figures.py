"""Figures a refresh counts while it writes, against the audits that read again."""

from pyspark.sql import functions as F

from warchest.operators import figures, quality, rollup
from warchest.plans import refresh
from warchest.sources import files, tables
from warchest.specs import SPECS

CATEGORY, STATE, OTH = SPECS["expenditures_by_category"], SPECS["expenditures_by_state"], SPECS["committee_transaction_summaries"]
CHANGES = "dataset string, cycle int, etag string, last_modified string, content_length bigint"


def line(spec, i, **more):
    values = {"cmte_id": "C1", "amndt_ind": "N", "transaction_dt": "01152020", "transaction_amt": "10.00", "sub_id": str(i), "category": "001", **more}
    return "|".join(values.get(c, "") for c in spec.columns) + "\n"


def applied(spark, landing, root, name, cycles):
    changes = spark.createDataFrame([(name, c, None, None, 1) for c in cycles], CHANGES)
    return {r.cycle: r for r in refresh.apply_changes(spark, changes, str(landing), root, f"{root}/manifest").collect()}


def check(spark, landing, root, spec, rows):
    raw = files.read_dataset(spark, str(landing), spec)
    audit = {r.election_cycle: r for r in rollup.exclusion_audit(raw, spec).collect()}
    table = tables.read_table(spark, f"{root}/{spec.name}")
    for cycle, r in rows.items():
        one = table.where(F.col("election_cycle") == cycle)
        profile, amounts = quality.table_profile(one, spec.name).first(), quality.amount_check(one).first()
        assert (r.row_count, r.extreme_rows, r.nonpositive_rows) == (profile.row_count, amounts.extreme_rows, amounts.nonpositive_rows)
        for name in ("input_rows", "memo_rows", "amended_rows", "duplicate_rows", "kept_rows"):
            assert r[name] == audit[cycle][name], (cycle, name)


def test_same_as_the_audits(spark, tmp_path):
    for spec, prefix in ((CATEGORY, "oppexp"), (OTH, "oth")):
        landing, root = tmp_path / prefix, str(tmp_path / f"{prefix}-tables")
        landing.mkdir()
        rows = [line(spec, i, cmte_id=f"C{i % 3}") for i in range(20)] + [line(spec, 3), line(spec, 4, memo_cd="X"), line(spec, 50, amndt_ind="A"),
                line(spec, 51, memo_cd="X", amndt_ind="A"), line(spec, 52, transaction_amt="9000000000000.00", cmte_id="C8")]
        (landing / f"2020_{prefix}20.txt").write_text("".join(rows))
        (landing / f"2018_{prefix}18.txt").write_text(line(spec, 1) + line(spec, 1, cmte_id="C0"))
        out = applied(spark, landing, root, spec.name, [2018, 2020])
        assert out[2020].extreme_rows == 1 and out[2020].duplicate_rows == 1 and out[2018].kept_rows == 1
        check(spark, landing, root, spec, out)


def test_nothing_left_does_not_wait(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    (landing / "2020_oppexp20.txt").write_text(line(CATEGORY, 1, memo_cd="X"))
    (landing / "2018_oppexp18.txt").write_text("\n")
    out = applied(spark, landing, root, CATEGORY.name, [2018, 2020])
    assert {r.status for r in out.values()} == {"applied"} and all(r.row_count in (0, None) for r in out.values())
    assert tables.read_table(spark, f"{root}/{CATEGORY.name}").count() == 0


def test_tables_without_a_rollup(spark, tmp_path):
    spec, root = SPECS["committee_registrations"], str(tmp_path / "tables")
    (tmp_path / "2020_cm20.txt").write_text("".join("|".join(f"{c}{i}" for c in spec.columns) + "\n" for i in range(3)))
    row = applied(spark, tmp_path, root, spec.name, [2020])[2020]
    assert (row.row_count, row.input_rows, row.kept_rows) == (3, None, None)


def test_one_scan(spark, tmp_path):
    (tmp_path / "2020_oth20.txt").write_text(line(OTH, 1))
    seen = figures.Figures(OTH, [2020])
    raw = files.read_dataset(spark, str(tmp_path), OTH)
    plan = seen.finished(refresh.build(seen.raw(raw), OTH))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") >= 2

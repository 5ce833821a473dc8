"""From landed files to linked totals and a quality report."""

import json

from warchest.plans import jobs
from warchest.sources import tables
from warchest.specs import INDIVIDUAL_COLUMNS, SPECS


def _line(columns, **values):
    return "|".join(str(values.get(c, "")) for c in columns) + "\n"


def test_whole_run(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    for cycle in (2018, 2020):
        short = cycle % 100
        (landing / f"{cycle}_cn{short}.txt").write_text(_line(
            SPECS["candidate_registrations"].columns, cand_id="H0CA00001", cand_name="LEE, BOB JR",
            cand_office_st="CA", cand_office="H", cand_pty_affiliation="DEM"))
        (landing / f"{cycle}_cm{short}.txt").write_text(_line(
            SPECS["committee_registrations"].columns, cmte_id="C00000001", cmte_nm="LEE FOR CONGRESS", cmte_tp="H",
            cmte_dsgn="P", cand_id="H0CA00001"))
    current = 2020
    first = {(r.dataset, r.cycle): r.status for r in jobs.update(spark, str(landing), root, current=current).collect()}
    assert set(first.values()) == {"applied"} and len(first) == 4
    assert jobs.update(spark, str(landing), root, current=current).count() == 0  # unchanged
    (landing / "2020_cm20.txt").write_text(_line(
        SPECS["committee_registrations"].columns, cmte_id="C00000001", cmte_nm="LEE AGAIN", cmte_tp="H",
        cmte_dsgn="P", cand_id="H0CA00001"))
    again = jobs.update(spark, str(landing), root, current=current).collect()
    assert [(r.dataset, r.cycle) for r in again] == [("committee_registrations", 2020)]
    forced = jobs.update(spark, str(landing), root, current=current, force=True).collect()
    assert len(forced) == 9 * 3 and {r.status for r in forced} == {"applied", "failed"}  # most files never landed
    names = {(r.election_cycle, r.cmte_nm) for r in tables.read_table(spark, f"{root}/committee_registrations").collect()}
    assert names == {(2018, "Lee For Congress"), (2020, "Lee Again")}

    member = {"id": {"bioguide": "L1"}, "name": {"first": "Robert", "last": "Lee"},
              "terms": [{"type": "rep", "start": "2019-01-03", "end": "2021-01-03", "state": "CA", "party": "Democrat"}]}
    (tmp_path / "old.json").write_text(json.dumps([member | {"name": {"first": "X", "last": "Y"}}]))
    (tmp_path / "new.json").write_text(json.dumps([member]))
    members = jobs.load_legislators(spark, str(tmp_path / "old.json"), str(tmp_path / "new.json"))
    jobs.create_crosswalk(spark, members, root)
    assert [tuple(r) for r in tables.read_table(spark, f"{root}/{jobs.CROSSWALK}").collect()] == [
        ("H0CA00001", "L1", "name_match", "high")]

    giving = tmp_path / "giving"
    giving.mkdir()
    gift = dict(cmte_id="C00000001", amndt_ind="N", name="DOE, JANE", transaction_amt="25.50")
    (giving / "2020_itcont.txt").write_text(
        _line(INDIVIDUAL_COLUMNS, transaction_dt="01152020", sub_id="1", **gift)
        + _line(INDIVIDUAL_COLUMNS, transaction_dt="02/01/2020", sub_id="2", **gift)
        + _line(INDIVIDUAL_COLUMNS, transaction_dt="2012020", sub_id="2", **gift))
    jobs.convert_individuals(spark, str(giving), root)
    jobs.add_years(spark, f"{root}/{jobs.INDIVIDUALS}", f"{root}/with_year")
    assert {r.transaction_year for r in tables.read_table(spark, f"{root}/with_year").collect()} == {2020}
    jobs.summarize_individuals(spark, root, open_cycle=2020)
    totals = tables.read_table(spark, f"{root}/{jobs.INDIVIDUAL_TOTALS}").collect()
    assert sorted((r.transaction_month, r.bioguide_id, float(r.total_raised), r.transaction_count) for r in totals) == [
        (1, "L1", 25.5, 1), (2, "L1", 25.5, 1)]

    report = {r.table_name: list(r.issues) for r in jobs.verify(spark, root).collect()}
    assert report["committee_registrations"] == [] and report["pac_party_summaries"] == ["File not found"]


def test_standardize_table(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.createDataFrame([(2020, "LEE, BOB", "12/31/2020"), (2022, "Lee, Bob", "2022-12-31")],
                               "election_cycle int, cand_name string, cvg_end_dt string")
    tables.write_partitioned(df, source)
    sample = jobs.standardize(spark, "all_candidate_summaries", source, target, dry_run=True)
    assert sorted(map(tuple, sample.collect())) == [
        ("cand_name", "LEE, BOB", "Lee, Bob"), ("cvg_end_dt", "12/31/2020", "2020-12-31")]
    assert tables.read_table_or_none(spark, target) is None
    jobs.standardize(spark, "all_candidate_summaries", source, target)
    done = tables.read_table(spark, target).collect()
    assert {(r.election_cycle, r.cand_name, r.cvg_end_dt) for r in done} == {
        (2020, "Lee, Bob", "2020-12-31"), (2022, "Lee, Bob", "2022-12-31")}


def test_datasets_at_the_same_time(spark, tmp_path, monkeypatch):
    """Three datasets are under way together; one that fails stops no other; the landing folder is listed once."""
    import threading

    from warchest.plans import refresh
    names = ["candidate_registrations", "committee_registrations", "pac_party_summaries"]
    landing, root = tmp_path / "landing", str(tmp_path / "tables")
    landing.mkdir()
    for name in names:
        (landing / f"2020_{SPECS[name].prefix}20.txt").write_text(_line(SPECS[name].columns, cmte_id="C1", cand_id="H1"))
    together, listings, pools, real, listed = threading.Barrier(3, timeout=60), [], set(), refresh.refresh_cycles, refresh.landed_files

    def rebuild(session, name, *rest):
        together.wait()  # breaks unless all three are here
        pools.add(session.sparkContext.getLocalProperty("spark.scheduler.pool"))
        if name == names[1]:
            raise RuntimeError("bad file")
        return real(session, name, *rest)

    monkeypatch.setattr(refresh, "refresh_cycles", rebuild)
    monkeypatch.setattr(refresh, "landed_files", lambda *args: (listings.append(args), listed(*args))[1])
    changes = spark.createDataFrame([(n, 2020, None, None, 1) for n in [*names, "unheard_of"]],
                                    "dataset string, cycle int, etag string, last_modified string, content_length bigint")
    out = {r.dataset: (r.status, r.error) for r in refresh.apply_changes(spark, changes, str(landing), root, f"{root}/manifest").collect()}
    assert out == {names[0]: ("applied", None), names[1]: ("failed", "bad file"), names[2]: ("applied", None), "unheard_of": ("failed", "unknown dataset")}
    assert pools == set(names) and len(listings) == 1
    assert {r.dataset for r in refresh.read_manifest(spark, f"{root}/manifest").collect()} == {names[0], names[2]}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None

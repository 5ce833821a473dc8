"""Reports as table functions: parameters, stored tables, plans."""

from warchest.plans import report_sql, reports
from warchest.sources import tables

GIVEN = "election_cycle int, cmte_id string, cmte_name string, cand_id string, transaction_tp string, total_amount decimal(30,2), transaction_count bigint"


def stored(spark, root):
    given = spark.createDataFrame([], GIVEN).union(spark.sql(
        "SELECT 2020 + 2 * int(id % 2), concat('C', id % 7), 'n', concat('H', id % 5), if(id % 3 = 0, '24K', '24E'), cast(id as decimal(30,2)), 1L FROM range(100)"))
    links = spark.sql("SELECT concat('H', id) AS cand_id, concat('B', id % 3) AS bioguide_id FROM range(5)")
    names = spark.createDataFrame([(2020, "C1", "A\\B PAC", "H", None, None), (2022, "C2", "f\\ x", "H", "H1", "P"), (2020, "C3", "plain", "H", None, None)],
                                  "election_cycle int, cmte_id string, cmte_nm string, cmte_tp string, cand_id string, cmte_dsgn string")
    tables.write_partitioned(given, f"{root}/committee_to_candidate_summaries")
    tables.write_table(links, f"{root}/cand_id_bioguide_crosswalk")
    tables.write_partitioned(names, f"{root}/committee_registrations")


def rows(df):
    return sorted(str(sorted((k, float(v) if k.startswith("total") else v) for k, v in r.asDict().items())) for r in df.collect())


def test_parameters_over_stored_tables(spark, tmp_path):
    root = str(tmp_path)
    stored(spark, root)
    made = report_sql.register(spark, root)
    assert set(made) == {"top_committees", "committee_search", "funders_of_candidates"}  # what the stored tables allow
    given, links = (tables.read_table(spark, f"{root}/{n}") for n in ("committee_to_candidate_summaries", "cand_id_bioguide_crosswalk"))
    for member, cycle, k in ((None, None, 20), ("B1", None, 2), ("B1", 2022, 3), (None, 2020, 1), ("nobody", 2020, 5)):
        call = ", ".join(f"{n} => {v!r}" for n, v in (("bioguide", member), ("in_cycle", cycle), ("k", k)) if v is not None)
        assert rows(spark.sql(f"SELECT * FROM top_committees({call})")) == rows(reports.top_committees(given, links, member, cycle, k)), call
    names = tables.read_table(spark, f"{root}/committee_registrations")
    for text in ("f\\ ", "\\", "a_b", "%", "PAC"):
        got = spark.sql("SELECT * FROM committee_search(:text, 2)", args={"text": text})
        assert rows(got) == rows(reports.committee_search(names, text, 2)), text
    joined = spark.sql("SELECT c.cmte_nm, f.total_amount FROM funders_of_candidates('H1') f JOIN committee_search('pac') c USING (cmte_id)")
    assert joined.count() > 0


def test_parameters_reach_the_scan(spark, tmp_path):
    root = str(tmp_path)
    stored(spark, root)
    report_sql.register(spark, root)
    plan = spark.sql("SELECT * FROM top_committees('B1', 2022)")._jdf.queryExecution().executedPlan().toString()
    assert "election_cycle" in plan.split("PartitionFilters: [")[1].split("]")[0] + plan.split("PartitionFilters: [")[-1].split("]")[0]
    assert "EqualTo(bioguide_id,B1)" in plan and "Python" not in plan

"""The index finds what the scan finds."""

import random

from warchest.operators import name_index
from warchest.plans import reports

SCHEMA = "election_cycle int, cmte_id string, cmte_nm string, cmte_tp string"


def registrations(spark):
    rng = random.Random(3)
    words = ["PAC", "Friends", "of", "A\\B", "50%", "a_b", "ÉCOLE", "ΟΔΟΣ", "Straße", "İzmir", "𝒳yz", "", "x", "committee"]
    names = [" ".join(rng.choices(words, k=rng.randint(0, 4))) for _ in range(300)] + [None, "", "ab", "ΟΔΟΣ"]
    rows = [(rng.choice([2020, 2022, None]), f"C{i % 120}", n, rng.choice(["H", "Q", None])) for i, n in enumerate(names)]
    return spark.createDataFrame(rows + rows[:20], SCHEMA)


def found(df):
    return [tuple(r) for r in df.collect()]


def test_same_rows_as_the_scan(spark, tmp_path):
    df, path = registrations(spark), str(tmp_path / "index")
    name_index.write_index(df, path)
    for text in ("pac", "PAC of", "", "a", "ab", "%", "_", "f_iends", "fri%pac", "pa%x%", "\\", "a\\b", "50%", "a_b", "école", "οδος", "οδοσ", "strasse",
                 "straße", "i̇zm", "𝒳yz", "yz", "nothing like it", "pac pac", "   ", "O'Brien \"x\""):
        for k in (3, 1000):
            assert found(name_index.indexed_search(spark, path, text, k)) == found(reports.committee_search(df, text, k)), (text, k)


def test_rebuild_and_empty(spark, tmp_path):
    df, path = registrations(spark), str(tmp_path / "index")
    name_index.write_index(df, path)
    name_index.write_index(spark.createDataFrame([(2024, "C1", "Brand New", "H")], SCHEMA), path)
    assert found(name_index.indexed_search(spark, path, "pac")) == []
    assert found(name_index.indexed_search(spark, path, "nd n")) == [("C1", "Brand New", "H", 2024)]
    name_index.write_index(df.limit(0), path)
    assert found(name_index.indexed_search(spark, path, "nd n")) == []


def test_only_lists_and_candidates_are_read(spark, tmp_path):
    df, path = registrations(spark), str(tmp_path / "index")
    name_index.write_index(df, path)
    grams = name_index.grams_of(spark, "fri%pac_x")
    assert grams == ["fri", "pac"]
    hits = name_index.candidates(spark, path, "friends")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(gram)" in plan or "In(gram" in plan
    assert "part" in plan.split("PartitionFilters: [")[1].split("]")[0] and "Python" not in plan
    names = {r.cmte_nm for r in hits.collect()}
    assert names and all("friends" in n.lower() for n in names)

"""What the roll-ups and loads of many tables share: one scan, one look for repeated ids, names once; tables side by side."""

import contextlib
import io
import threading

import pytest
from pyspark.sql import functions as F

from warchest.operators import rollup
from warchest.plans import jobs, refresh
from warchest.sources import catalog, tables
from warchest.specs import SPECS
from workload import catalog as workload

ITEMIZED = [SPECS[n] for n in ("committee_to_candidate_summaries", "committee_transaction_summaries", "expenditures_by_category", "expenditures_by_state")]
COLUMNS = ("election_cycle int, sub_id string, cmte_id string, other_id string, name string, cand_id string, transaction_tp string, transaction_dt string, "
           "transaction_amt decimal(20,2), category string, category_desc string, state string, memo_cd string, amndt_ind string")


def row(i, sub_id, cycle=2000, **other):
    made = {"election_cycle": cycle, "sub_id": sub_id, "cmte_id": f"C{i % 3}", "other_id": f"D{i % 2}", "name": ("SMITH, BOB", "SMITH,  BOB", None, "MCKAY PAC")[i % 4],
            "cand_id": f"H{i % 2}", "transaction_tp": "24K", "transaction_dt": "01/02/2000" if i % 5 else "BADDATE", "transaction_amt": None if i % 7 == 3 else i,
            "category": f"00{i % 2}", "category_desc": None, "state": "NA", "memo_cd": None, "amndt_ind": None} | other
    return tuple(str(v) if k == "transaction_amt" and v is not None else v for k, v in made.items())


@pytest.fixture
def transactions(spark):
    rows = [row(i, f"s{i}") for i in range(40)]
    # of one id, each family keeps another row
    rows += [row(50, "twice", other_id="D0", name="Z", cand_id="H9", category="009"), row(50, "twice", other_id="D9", name="A", cand_id="H1", category="001")]
    rows += [row(51, "twice", 2002), row(52, "same"), row(52, "same"), row(53, "s1", memo_cd="X"), row(54, "s2", amndt_ind="A")]
    rows += [row(60 + i, None) for i in range(9)] + [row(70, "x", None), row(71, "x", None), row(72, None, None)]
    text = spark.createDataFrame(rows, COLUMNS.replace("decimal(20,2)", "string")).repartition(5)
    return text.withColumn("transaction_amt", F.col("transaction_amt").cast("decimal(20,2)"))


@pytest.mark.parametrize("sent", [rollup.SENT_IDS, 0])
def test_prepared_rollups_are_the_rollups(spark, tmp_path, monkeypatch, transactions, sent):
    monkeypatch.setattr(rollup, "SENT_IDS", sent)
    if not sent:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = rollup.prepare(transactions, ITEMIZED, lambda df, name: tables.stored(df, str(tmp_path / name)))
        assert made.again.count() == 2 + 2 + 9 + 2  # of "twice", "same", no id, "x" without a cycle
        for spec in ITEMIZED:
            want, got = rollup.rollup(transactions, spec), rollup.rollup(made, spec)
            assert got.schema.simpleString() == want.schema.simpleString()
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())), spec.name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_prepared_is_per_cycle_and_for_equal_columns(spark, transactions):
    with pytest.raises(ValueError):
        rollup.rollup(rollup.Prepared(transactions, transactions, {}), ITEMIZED[0], "global")
    other = type(ITEMIZED[0])("other", "oth", 1980, ("sub_id",), memo="no_memo")
    with pytest.raises(ValueError):
        rollup.prepare(transactions, [ITEMIZED[0], other], lambda df, name: df)


def test_finished_tables_read_transactions_once(spark, monkeypatch):
    reads, txn = [], workload.txn
    monkeypatch.setattr(workload, "txn", lambda *a: reads.append(a) or txn(*a))
    workload._finished(spark, "/root/testdata/sf0.001")
    assert len(reads) == 1


def test_audit_lists_no_reasons_for_rows_that_hold(spark):
    """Functions on arrays with a lambda are neither compiled nor skipped for good rows."""
    df = spark.createDataFrame([("2020", "2020", "C1", "CA", "5.5", "1"), ("x", None, None, "CA", "y", " ")],
                               "election_cycle string, transaction_year string, cmte_id string, state string, total_amount string, transaction_count string")
    out = catalog.audited(df, catalog.REPORT_TABLES["fec_expenditures_by_state"])
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        out.explain(True)
    assert "lambda" not in plan.getvalue()
    assert [(r.reasons, r.rejected) for r in out.orderBy("rejected").collect()] == [
        ([], False), (["unreadable election_cycle", "unreadable total_amount", "missing election_cycle", "missing transaction_year", "missing cmte_id"], True)]


def test_tables_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    both, load = threading.Barrier(2, timeout=60), catalog.load_table
    monkeypatch.setattr(catalog, "load_table", lambda *a, **k: both.wait() and None or load(*a, **k))
    rows = spark.createDataFrame([("C1", 2020), ("C1", 2020)], "cmte_id string, election_cycle int")
    for name in ("committee_registrations", "pac_party_summaries"):
        columns = catalog.REPORT_TABLES["fec_committees" if name == "committee_registrations" else "fec_pac_summaries"].columns
        tables.write_table(rows.select(*[c if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]), f"{tmp_path}/root/{name}")
    keys = jobs.load_report_tables(spark, f"{tmp_path}/root", f"{tmp_path}/target")
    assert [(r.table_name, r.row_count) for r in keys.collect()] == [("fec_committees", 2), ("fec_pac_summaries", 2)]


def test_side_by_side_ends_all_before_an_error(spark):
    done = []

    def fail():
        raise KeyError("first")

    with pytest.raises(KeyError):
        refresh.side_by_side(spark, {"fail": fail, "run": lambda: done.append(spark.range(3).count())})
    assert done == [3] and refresh.side_by_side(spark, {}) == {}

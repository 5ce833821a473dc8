"""Steps that large tables go through: code the JVM compiles, no shuffle where none is needed."""

import contextlib
import datetime
import io
import re

import pytest
from pyspark.sql import functions as F

from warchest.sources import lines
from workload import catalog

COMPILED = 8000  # bytes a method
SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("small"))
    day = datetime.datetime(1995, 3, 4)
    made = [(o, o % 40, o % 3, o % 7 + 1, float(o % 15), 10.25, 0.0, 0.02 * (o % 2), "NRA"[o % 3], "OF"[o % 2], day) for o in range(300)]
    spark.createDataFrame(made, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    parts = [(k, None if k == 3 else f"cold part{k}", "Brand#1", "ECONOMY", k, 900.0) for k in range(32)] + [(5, "twice widget", "Brand#1", "PROMO", 7, 1.0)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    return d


@pytest.fixture
def fixed(spark):
    """Plans as they are before they run."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def shown(df, mode):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def largest(df):
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown(df, "codegen")))


def test_transactions_are_the_rows_of_the_sql(spark, small):
    from workload.views import TABLES, with_views

    tables = {t: f"parquet.`{small}/{t}.parquet`" for t in TABLES}
    want, got = spark.sql(with_views("SELECT * FROM txn", tables)), catalog.txn(spark, small)
    assert got.schema.simpleString() == want.schema.simpleString() and got.count() == want.count() > 200
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_code_of_transactions_is_compiled(spark, small, fixed):
    assert largest(catalog.txn(spark, small)) < COMPILED


def test_code_of_spoilt_lines_is_compiled(spark, small, fixed, monkeypatch):
    landed = []
    monkeypatch.setattr(catalog, "land", lambda spark, df, *a, **k: landed.append(df))
    catalog._spoilt_landing(spark, small)
    assert largest(landed[0]) < COMPILED


def test_landing_does_not_shuffle(spark):
    rows = spark.range(90, numPartitions=3).select(F.lit(2000).alias(catalog.CYCLE), F.concat(F.lit("line "), "id").alias("line"))
    spec = catalog.DatasetSpec(catalog.OTH.name, catalog.OTH.prefix, catalog.OTH.start_year, ("line",))
    landing = catalog.land(spark, rows, spec, "landed")
    read = catalog.files.read_lines(spark, landing, catalog.files.landing_glob(catalog.OTH))
    assert sorted(r.value for r in read.collect()) == sorted(f"line {i}" for i in range(90))
    assert len(read.inputFiles()) == 3  # one a task


def test_line_numbers_do_not_shuffle_lines(spark, fixed):
    rows = spark.createDataFrame([(2000, "f", 0, 0, "x", ["too few fields"], True)], "election_cycle int, _file string, _block long, _turn long, "
                                 "_line string, reasons array<string>, rejected boolean")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in shown(lines.numbered(rows), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

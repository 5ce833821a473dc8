"""Load of the finished tables into the typed reporting tables: written, audited, then published.

A load is staged as a version nobody reads.  Every row carries the constraints it breaks: a missing required value, text no number can be
made of, a key that another row has.  What happens then is the caller's choice:

- ``hold``: a load with such a row is not published, the table stays as it was;
- ``divert``: the rows that hold are published, of equal keys the smallest row;
- ``report``: everything is published.

In each case the rows that break a constraint are listed, with their reasons, in ``<table>.rejected``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.clean import CYCLE
from .tables import read_table_or_none, write_table
from .versions import Staged, VersionedTable


@dataclass(frozen=True)
class ReportTable:
    source: str
    columns: dict[str, tuple[str, str]]  # source column -> (target column, type)
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()  # besides the key


def _texts(*names: str) -> dict[str, tuple[str, str]]:
    return {n: (n, "string") for n in names}


def _money(*names: str) -> dict[str, tuple[str, str]]:
    return {n: (n, "double") for n in names}


_YEAR = {CYCLE: ("year", "int")}
_PERIOD = {CYCLE: (CYCLE, "int"), "transaction_year": ("transaction_year", "int")}
_SUMS = {"total_amount": ("total_amount", "double"), "transaction_count": ("transaction_count", "bigint")}

# Reporting tables, their columns and keys.
REPORT_TABLES: dict[str, ReportTable] = {
    "fec_candidate_mapping": ReportTable(
        "cand_id_bioguide_crosswalk", _texts("bioguide_id", "cand_id"), ("bioguide_id", "cand_id")),
    "fec_candidate_summaries": ReportTable(
        "all_candidate_summaries",
        {**_texts("cand_id"), **_YEAR, **_texts("cand_name", "cand_ici"),
         "cand_pty_affiliation": ("party_code", "string"),
         **_money("ttl_receipts", "ttl_disb", "coh_cop", "ttl_indiv_contrib", "other_pol_cmte_contrib",
                  "pol_pty_contrib", "cand_contrib", "cand_loans", "debts_owed_by", "trans_from_auth",
                  "trans_to_auth"),
         **_texts("cvg_end_dt")},
        ("cand_id", "year")),
    "fec_committees": ReportTable(
        "committee_registrations",
        {**_texts("cmte_id"), **_YEAR,
         **_texts("cmte_nm", "cmte_tp", "cmte_dsgn", "cmte_pty_affiliation", "connected_org_nm", "cand_id")},
        ("cmte_id", "year")),
    "fec_pac_summaries": ReportTable(
        "pac_party_summaries",
        {**_texts("cmte_id"), **_YEAR, **_texts("cmte_nm", "cmte_tp"),
         **_money("ttl_receipts", "ttl_disb", "coh_cop", "indv_contrib", "other_pol_cmte_contrib",
                  "contrib_to_other_cmte", "ind_exp")},
        ("cmte_id", "year")),
    "fec_committee_to_candidate": ReportTable(
        "committee_to_candidate_summaries",
        {**_PERIOD, **_texts("cmte_id", "cmte_name", "cand_id", "transaction_tp"), **_SUMS},
        required=(CYCLE, "transaction_year", "cmte_id", "cand_id")),
    "fec_committee_transactions": ReportTable(
        "committee_transaction_summaries",
        {**_PERIOD, **_texts("source_cmte_id", "dest_cmte_id", "dest_name", "transaction_tp"), **_SUMS},
        required=(CYCLE, "transaction_year", "source_cmte_id", "dest_cmte_id")),
    "fec_expenditures_by_category": ReportTable(
        "expenditures_by_category", {**_PERIOD, **_texts("cmte_id", "category", "category_desc"), **_SUMS},
        required=(CYCLE, "transaction_year", "cmte_id")),
    "fec_expenditures_by_state": ReportTable(
        "expenditures_by_state", {**_PERIOD, **_texts("cmte_id", "state"), **_SUMS},
        required=(CYCLE, "transaction_year", "cmte_id")),
}


def _typed(table: ReportTable) -> list[Column]:
    return [F.col(src).try_cast(kind).alias(name) for src, (name, kind) in table.columns.items()]


def report_table(df: DataFrame, table: ReportTable, since: int | None = None) -> DataFrame:
    """Typed rows of a reporting table; ``since`` loads recent cycles only."""
    rows = df if since is None else df.where(F.col(CYCLE) >= since)
    return rows.select(*_typed(table))


def key_violations(df: DataFrame, name: str) -> DataFrame:
    """(table_name, key, row_count) of keys of a reporting table that are missing or occur twice.
    A table without a key has none."""
    key = REPORT_TABLES[name].key
    text = F.to_json(F.struct(*key)) if key else F.lit(None).cast("string")
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
    missing = F.lit(False)
    for c in key:
        missing = missing | F.col(c).isNull()
    bad = counted.where((F.col("row_count") > 1) | missing) if key else counted.where(F.lit(False))
    return bad.select(F.lit(name).alias("table_name"), text.alias("key"), "row_count")


REASONS, BROKEN = "reasons", "rejected"


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def _reasons(broken: dict[str, Column]) -> Column:
    """The names of the conditions that hold.  Nearly all rows break none and make no array of their own; the code is
    compiled with the scan's, which functions on arrays with a lambda would not be."""
    none = F.array().cast("array<string>")
    listed = [F.when(c, F.array(F.lit(name))).otherwise(none) for name, c in broken.items()]
    return F.when(_any(list(broken.values())), F.concat(*listed)).otherwise(none) if listed else none


def audited(df: DataFrame, table: ReportTable, since: int | None = None, spare_first: bool = False) -> DataFrame:
    """Typed rows with the constraints each one breaks.  ``spare_first``: of rows with one key the smallest breaks nothing.

    Only tables with a key shuffle, by it; rows without a whole key are spread, however many they are.
    """
    rows = df if since is None else df.where(F.col(CYCLE) >= since)
    # the text is looked at only where the conversion failed
    unreadable = {
        f"unreadable {name}": F.col(src).try_cast(kind).isNull() & (F.trim(F.col(src).cast("string")) != "")
        for src, (name, kind) in table.columns.items() if kind != "string"}
    typed = rows.select(*_typed(table), _reasons(unreadable).alias(REASONS))
    names = [name for name, _ in table.columns.values()]
    missing = {c: F.col(c).isNull() for c in dict.fromkeys([*table.key, *table.required])}
    found = {f"missing {c}": m for c, m in missing.items()}
    if table.key:
        spread = F.when(_any([missing[c] for c in table.key]), F.xxhash64(*names))
        same = Window.partitionBy(*table.key, spread)
        again = F.row_number().over(same.orderBy(*[F.col(n).asc_nulls_first() for n in names])) if spare_first else F.count(F.lit(1)).over(same)
        typed = typed.withColumn("_again", again)
        found["repeated key"] = (F.col("_again") > 1) & spread.isNull()
    reasons = F.when(_any(list(found.values())), F.concat(REASONS, _reasons(found))).otherwise(F.col(REASONS))
    return typed.select(*names, reasons.alias(REASONS)).withColumn(BROKEN, F.size(REASONS) > 0)


@dataclass(frozen=True)
class Load:
    """What became of one table."""

    table: str
    published: bool
    rows: int
    rejected: int


def load_table(df: DataFrame, name: str, path: str, since: int | None = None, on_violation: str = "hold") -> Load:
    """Write, audit, publish one reporting table."""
    if on_violation not in ("hold", "divert", "report"):
        raise ValueError(on_violation)
    table, spark = REPORT_TABLES[name], df.sparkSession
    rows = audited(df, table, since, spare_first=on_violation == "divert")
    staged = VersionedTable(spark, path).stage(rows, BROKEN)
    try:
        written = staged.read()
        counts = {r[BROKEN]: r["count"] for r in written.groupBy(BROKEN).count().collect()}
        broken = counts.get(True, 0)
        listed = written.where(BROKEN).drop(BROKEN)
        if broken or read_table_or_none(spark, f"{path}.rejected") is not None:
            write_table(listed, f"{path}.rejected")
    except Exception:
        staged.discard()
        raise
    if broken and on_violation == "hold":
        staged.discard()
        return Load(name, False, 0, broken)
    _publish(staged, rows.drop(REASONS, BROKEN), keep=None if on_violation == "report" else "false")
    return Load(name, True, sum(counts.values()) if on_violation == "report" else counts.get(False, 0), broken)


def _publish(staged: Staged, shape: DataFrame, keep: str | None) -> None:
    """The staged rows as the table, without what the audit added."""
    folders = {k: f for k, f in staged.folders().items() if keep is None or k == f"{BROKEN}={keep}"}
    staged.table.publish(shape.schema, folders, staged.table.current())


def rejected_rows(spark: SparkSession, target: str) -> DataFrame:
    """(table_name, reason, row): every broken constraint of the last loads, the row as JSON."""
    out = spark.createDataFrame([], "table_name string, reason string, row string")
    for name in REPORT_TABLES:
        found = read_table_or_none(spark, f"{target}/{name}.rejected")
        if found is not None:
            row = F.to_json(F.struct(*[c for c in found.columns if c != REASONS]))
            out = out.unionByName(found.select(F.lit(name).alias("table_name"), F.explode(REASONS).alias("reason"), row.alias("row")))
    return out

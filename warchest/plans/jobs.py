"""End-to-end jobs over a landing folder and a folder of finished tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import capitalize_name, iso_date
from ..operators import clean, combine, crosswalk, legislators, manifest, quality, rollup
from ..sources import catalog, files, tables
from ..specs import (INDIVIDUAL_COLUMNS, INDIVIDUAL_NAME_COLUMNS, SPECS, TABLE_DATE_COLUMNS,
                     TABLE_NAME_COLUMNS, schema_of)
from .refresh import apply_changes, landed_files, side_by_side, table_path

INDIVIDUALS = "individual_contributions"
CROSSWALK = "cand_id_bioguide_crosswalk"
INDIVIDUAL_TOTALS = "candidate_individual_contribution_summaries"


# Refresh ------------------------------------------------------------------------------


def landed_state(spark: SparkSession, landing: str) -> DataFrame:
    """State of the landed files per (dataset, cycle), from the file listing alone."""
    return landed_files(spark, landing).groupBy("dataset", "cycle").agg(
        F.lit(None).cast("string").alias("etag"),
        F.date_format(F.max("modificationTime"), "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("last_modified"),
        F.sum("length").alias("content_length"))


def update(spark: SparkSession, landing: str, root: str, force: bool = False, current: int | None = None,
           cycles: list[int] | None = None, dry_run: bool = False) -> DataFrame:
    """Detect changed cycles, rebuild them, advance the state of those that succeed.

    Without ``cycles`` the current cycle and the two before it are looked at.  ``force``
    rebuilds all of them when nothing has changed.
    """
    current = current or manifest.current_cycle()
    cycles = cycles or [current, current - 2, current - 4]
    store = f"{root}/manifest"
    known = tables.read_table_or_none(spark, store)
    if known is None:
        known = spark.createDataFrame([], "dataset string, cycle int, etag string, last_modified string, "
                                          "content_length bigint, last_updated string")
    starts = manifest.start_years(spark)
    seen = landed_state(spark, landing).join(starts, "dataset")
    seen = seen.where(F.col("cycle").isin(cycles) & (F.col("cycle") >= F.col("start_year")))
    changes = manifest.manifest_diff(known, seen)
    if force and changes.isEmpty():
        changes = manifest.forced_changes(starts, cycles)
    return apply_changes(spark, changes, landing, root, store, dry_run)


# Individual contributions ---------------------------------------------------------------


def convert_individuals(spark: SparkSession, landing: str, root: str, glob: str | None = None) -> None:
    """Landed contribution files to a table partitioned by cycle, names standardised."""
    raw = files.read_pipe(spark, landing, schema_of(INDIVIDUAL_COLUMNS),
                          glob or f"[0-9][0-9][0-9][0-9]_*.{files.any_case('txt')}")
    tables.replace_cycles(combine.combine_individuals(raw), table_path(root, INDIVIDUALS), ["cmte_id"])


def add_years(spark: SparkSession, source: str, target: str, force: bool = False) -> None:
    """Contributions with their transaction year, written to another folder."""
    rows = tables.read_table(spark, source)
    first = rows.select(clean.CYCLE, *[c for c in rows.columns if c != clean.CYCLE])
    tables.replace_cycles(clean.add_transaction_year(first, force), target, ["cmte_id"])


def summarize_individuals(spark: SparkSession, root: str, open_cycle: int = rollup.OPEN_CYCLE,
                          cycle: int | None = None, dry_run: bool = False, expand: bool = True) -> DataFrame:
    """Contributions by candidate, linked to legislators through the crosswalk, which ``expand`` widens
    to all ids of a candidate's name.  The table is partitioned by cycle; ``cycle`` replaces one."""
    rows = tables.read_table(spark, table_path(root, INDIVIDUALS))
    rows = rows if cycle is None else clean.cycle_slice(rows, cycle)
    links = tables.read_table_or_none(spark, table_path(root, CROSSWALK))
    candidates = tables.read_table_or_none(spark, table_path(root, "candidate_registrations"))
    if expand and links is not None and candidates is not None:
        links = crosswalk.expand_by_name(links, candidates)
    out = rollup.individual_by_candidate(
        rows, tables.read_table(spark, table_path(root, "committee_registrations")), links, open_cycle)
    if not dry_run:
        order = ["transaction_year", "transaction_month", "cand_id"]
        target = table_path(root, INDIVIDUAL_TOTALS)
        if cycle is None:
            tables.write_partitioned(out, target, order)
        else:
            tables.replace_cycle(out, target, cycle, order)
    return out


# Crosswalk ------------------------------------------------------------------------------


def load_legislators(spark: SparkSession, historical: str, current: str, multi_line: bool = True) -> DataFrame:
    """Both published files as one table, most recent terms first."""
    old, new = (files.read_legislators(spark, p, multi_line) for p in (historical, current))
    return legislators.most_recent_first(legislators.merge_legislators(old, new))


def create_crosswalk(spark: SparkSession, members: DataFrame, root: str, keep_unverified: bool = False,
                     overrides: DataFrame | None = None, expected: DataFrame | None = None,
                     cycles: tuple[int, int] = crosswalk.CYCLES) -> DataFrame | None:
    """Build and store the crosswalk.  ``overrides`` (name, bioguide_id) correct the legislators'
    ids first; ``expected`` pairs are checked against the stored table and their status returned."""
    candidates = tables.read_table(spark, table_path(root, "candidate_registrations"))
    if overrides is not None:
        full = F.concat_ws(" ", "name.first", "name.last", "name.suffix")
        named = members.select("*", full.alias("_full"), F.col("id.bioguide").alias("_found"))
        fixed = crosswalk.apply_overrides(named, overrides, "_full", "_found")
        members = fixed.withColumn("id", F.col("id").withField("bioguide", F.col("_found"))).select(*members.columns)
    links = crosswalk.unverified(members, candidates) if keep_unverified else crosswalk.build_crosswalk(
        members, candidates, cycles=cycles)
    tables.write_table(links, table_path(root, CROSSWALK), ["cand_id"])
    if expected is None:
        return None
    return crosswalk.check_expected(tables.read_table(spark, table_path(root, CROSSWALK)), expected)


# Reporting tables -----------------------------------------------------------------------


def load_report_tables(spark: SparkSession, root: str, target: str, since: int | None = None,
                       on_violation: str = "hold") -> DataFrame:
    """Load every reporting table whose source is there; returns the violated keys of all.

    A load that breaks a constraint is handled as ``on_violation`` says (see ``sources.catalog``); the rows that break one are
    listed by ``catalog.rejected_rows``.  A few tables are loaded at the same time; when one fails, the others are loaded before its error is raised.
    """
    found = spark.createDataFrame([], "table_name string, key string, row_count bigint")

    def load(name: str) -> DataFrame | None:
        table = catalog.REPORT_TABLES[name]
        source = tables.read_table_or_none(spark, table_path(root, table.source))
        if source is None:
            return None
        path = table_path(target, name)
        done = catalog.load_table(source, name, path, since if clean.CYCLE in source.columns else None, on_violation)
        if not done.rejected or not table.key:
            return None
        broken = tables.read_table(spark, f"{path}.rejected")
        keyless = F.exists(catalog.REASONS, lambda r: (r == "repeated key") | r.isin(*[f"missing {c}" for c in table.key]))
        return broken.where(keyless).groupBy(*table.key).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.to_json(F.struct(*table.key)).alias("key"), "row_count")

    for part in side_by_side(spark, {name: partial(load, name) for name in catalog.REPORT_TABLES}).values():
        found = found if part is None else found.unionByName(part)
    return found


# Standardisation and validation ---------------------------------------------------------


def standardize(spark: SparkSession, name: str, source: str, target: str, dry_run: bool = False) -> DataFrame | None:
    """Names and dates of one finished table, written to another folder.  A dry run returns a
    sample of the values that would change."""
    df = tables.read_table(spark, source)
    names = INDIVIDUAL_NAME_COLUMNS if name == INDIVIDUALS else TABLE_NAME_COLUMNS.get(name, ())
    dates = TABLE_DATE_COLUMNS.get(name, ())
    if dry_run:
        return clean.changed_values(df, {
            **dict.fromkeys(names, capitalize_name), **dict.fromkeys(dates, lambda c: iso_date(c, keep_iso=True))})
    done = clean.standardize_dates(clean.standardize_names(df, names), dates)
    tables.write_partitioned(done, target)
    return None


def verify(spark: SparkSession, root: str) -> DataFrame:
    """Quality report over every finished table."""
    return quality.quality_report(
        spark, {name: tables.read_table_or_none(spark, table_path(root, name)) for name in SPECS})

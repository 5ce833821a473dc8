"""Refresh of finished tables by election cycle."""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import figures as observed
from ..operators.clean import CYCLE
from ..operators.combine import combine_cycles
from ..functions.text import lookup
from ..operators.manifest import KEY, STATE, refreshable
from ..operators.rollup import fine_expenditures, regroup, rollup
from ..sources.files import any_case, cycle_of_file, landing_glob, read_pipe
from ..sources.tables import replace_cycles
from ..specs import SPECS, DatasetSpec

log = logging.getLogger(__name__)

#: Datasets that a refresh rebuilds at the same time.
AT_ONCE = 3

_STATE_ROW = "dataset string, cycle int, etag string, last_modified string, content_length bigint"


def table_path(tables: str, name: str) -> str:
    return f"{tables}/{name}"


def build(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Finished rows of a family from its raw rows."""
    return rollup(df, spec) if spec.is_rollup else combine_cycles(df, spec)


def sort_columns(spec: DatasetSpec) -> list[str]:
    return list(spec.group_by) or [spec.columns[0]]


def store_cycles(raw: DataFrame, spec: DatasetSpec, table: str, cycles: list[int]) -> dict[int, dict[str, int | None]]:
    """Rebuild ``cycles`` of a table from their raw rows, and of the tables that share its files.
    A cycle that has no rows left is emptied.  Returns the table's figures per cycle, counted while it was written."""
    followers = [s for s in SPECS.values() if s.same_file_as == spec.name]
    seen = observed.Figures(spec, cycles)
    raw = seen.raw(raw) if spec.is_rollup else raw
    if not followers:
        replace_cycles(seen.finished(build(raw, spec)), table, sort_columns(spec), touched=cycles)
        return seen.rows()
    # One pass over the files; only their small fine grouping is kept for the second write.
    fine = fine_expenditures(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        replace_cycles(seen.finished(regroup(fine, spec)), table, sort_columns(spec), touched=cycles)
        root = table.rstrip("/").rpartition("/")[0]
        for s in followers:
            replace_cycles(regroup(fine, s), table_path(root, s.name), sort_columns(s), touched=cycles)
    finally:
        fine.unpersist()
    return seen.rows()


def refresh_cycles(spark: SparkSession, name: str, cycles: list[int], landing: str, tables: str) -> dict[int, dict[str, int | None]]:
    """Rebuild cycles of one dataset, and of the datasets that share its files, in one plan; returns their figures."""
    spec = SPECS[name]
    globs = "{" + ",".join(landing_glob(spec, c) for c in sorted(cycles)) + "}"
    return store_cycles(read_pipe(spark, landing, spec.raw_schema, globs), spec, table_path(tables, name), cycles)


def preview(spark: SparkSession, name: str, cycles: list[int], landing: str, sample: int = 5) -> DataFrame:
    """Dry run: (cycle, row_count, sample) of what a refresh would store, the sample as text."""
    spec = SPECS[name]
    globs = "{" + ",".join(landing_glob(spec, c) for c in sorted(cycles)) + "}"
    out = build(read_pipe(spark, landing, spec.raw_schema, globs), spec)
    first = F.row_number().over(Window.partitionBy(CYCLE).orderBy(*sort_columns(spec)))
    few = out.withColumn("_rank", first).where(F.col("_rank") <= sample).drop("_rank")
    few = few.groupBy(CYCLE).agg(F.collect_list(F.to_json(F.struct(*out.columns))).alias("sample"))
    counts = out.groupBy(CYCLE).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(few, CYCLE).select(F.col(CYCLE).alias("cycle"), "row_count", "sample")


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """(dataset, cycle, modificationTime, length) of all landed files of refreshable datasets, from one listing."""
    prefixes = {SPECS[n].prefix: n for n in refreshable()}
    name = F.element_at(F.split("path", "/"), -1)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"[0-9][0-9][0-9][0-9]_*.{any_case('txt')}")
        .option("recursiveFileLookup", "true")
        .load(landing)
    )
    return files.select(
        lookup(prefixes, F.lower(F.regexp_extract(name, r"(?i)\A[0-9]{4}_(.+)[0-9]{2}\.txt\z", 1))).alias("dataset"),
        cycle_of_file(name).alias("cycle"), "modificationTime", "length").where("dataset IS NOT NULL")


def record_state(change: DataFrame, manifest: str) -> None:
    """Store the state of applied (dataset, cycle) pairs; each pair is a folder of its own."""
    stamped = change.select(*KEY, *STATE, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("last_updated"))
    out = stamped.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(*KEY).parquet(manifest)


def side_by_side(spark: SparkSession, tasks: dict[str, Callable[[], Any]], at_once: int = AT_ONCE) -> dict[str, Any]:
    """Runs independent tasks, ``at_once`` at a time, each in a scheduler pool of its own, so that the tail of one does not leave
    executors idle.  All of them end before the first error, in the tasks' order, is raised."""
    def run(name: str) -> Any:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return tasks[name]()

    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        running = {name: pool.submit(run, name) for name in tasks}
    return {name: one.result() for name, one in running.items()}


def apply_changes(spark: SparkSession, changes: DataFrame, landing: str, tables: str, manifest: str,
                  dry_run: bool = False, at_once: int = AT_ONCE) -> DataFrame:
    """Rebuild every changed (dataset, cycle); state advances only for those that succeed.

    The change list is small by nature (datasets times cycles).  All cycles of a dataset are one
    plan, one replacement and one state write; only if that fails are its cycles tried one by
    one, so that a bad cycle does not hold back the others.  Datasets are independent: up to
    ``at_once`` of them run at the same time, each in a scheduler pool of its own, so that the tail of a
    large one does not leave executors idle.  A dry run stores nothing and
    reports the rows each cycle would have.  Otherwise the figures of each cycle come back: the rows
    written and checked, and what exclusions left out, counted by the job that wrote them.
    """
    by_dataset: dict[str, list] = {}
    for row in changes.select(*KEY, *STATE).orderBy(*KEY).collect():
        by_dataset.setdefault(row.dataset, []).append(row)
    landed = {tuple(r) for r in landed_files(spark, landing).select(*KEY).distinct().collect()} if by_dataset else set()
    one_state_at_a_time = threading.Lock()

    def told(figures: dict) -> tuple:
        return tuple(figures.get(c) for c in observed.COLUMNS)

    def run(name: str, cycles: list[int], rows: list) -> dict[int, dict]:
        if dry_run:
            found = preview(spark, name, cycles, landing).select("cycle", "row_count").collect()
            return {c: {"row_count": 0} for c in cycles} | {r.cycle: {"row_count": r.row_count} for r in found}
        figures = refresh_cycles(spark, name, cycles, landing, tables)
        with one_state_at_a_time:
            record_state(spark.createDataFrame([tuple(r) for r in rows], _STATE_ROW), manifest)
        return figures if isinstance(figures, dict) else {}  # who replaces refresh_cycles need not count

    def dataset(name: str) -> list[tuple]:
        rows, outcome = by_dataset[name], []
        if name not in SPECS:
            return [(name, r.cycle, "failed", "unknown dataset", *told({})) for r in rows]
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        outcome += [(name, r.cycle, "failed", f"no landed file for {name} {r.cycle}", *told({})) for r in rows if (name, r.cycle) not in landed]
        rows = [r for r in rows if (name, r.cycle) in landed]
        batches = [rows, *([r] for r in rows)] if len(rows) > 1 else [rows] if rows else []
        for k, batch in enumerate(batches):
            cycles = [r.cycle for r in batch]
            try:
                figures = run(name, cycles, batch)
                outcome += [(name, c, "applied", None, *told(figures.get(c, {}))) for c in cycles]
                if not k:
                    break
            except Exception as error:  # noqa: BLE001 - one bad cycle must not stop the rest
                log.warning("refresh of %s %s failed: %s", name, cycles, error)
                if len(batch) == 1:
                    outcome.append((name, cycles[0], "failed", str(error).split("\n", 1)[0], *told({})))
        return outcome

    with ThreadPoolExecutor(max(1, min(at_once, len(by_dataset)))) as pool:
        done = [pool.submit(dataset, name) for name in by_dataset]
    outcome = [row for one in done for row in one.result()]
    return spark.createDataFrame(outcome, f"dataset string, cycle int, status string, error string, {observed.SCHEMA}")


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """Stored state; dataset and cycle come back from the folder names."""
    return spark.read.parquet(manifest).select(
        F.col("dataset").cast("string"), F.col("cycle").cast("int"), *STATE, "last_updated")

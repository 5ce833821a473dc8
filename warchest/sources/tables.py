"""Writers.  Parquet partitioned by cycle is the stored form; CSV is an export.

Tables are versions and pointers (`versions`): a write becomes visible in one step, for all its cycles."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import CYCLE
from .versions import Staged, VersionedTable, read, read_or_none


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path)


def read_table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if there is no such folder.  Any other problem is an error."""
    return read_or_none(spark, path)


def stage_table(df: DataFrame, path: str, sort: list[str] | None = None) -> Staged:
    """A version of the whole table that is not yet visible."""
    return VersionedTable(df.sparkSession, path).stage(df.sortWithinPartitions(*sort) if sort else df)


def stage_cycles(df: DataFrame, path: str, sort: list[str] | None = None) -> Staged:
    """Cycles of a table, not yet visible."""
    return VersionedTable(df.sparkSession, path).stage(by_cycle(df, sort), CYCLE)


def folder_of(cycle: int) -> str:
    return f"{CYCLE}={cycle}"


def write_table(df: DataFrame, path: str, sort: list[str] | None = None, backup: bool = False) -> None:
    """Whole-table overwrite; ``backup`` keeps the previous table readable as ``<path>.bak``."""
    stage_table(df, path, sort).publish(backup=backup)


def stored(df: DataFrame, path: str) -> DataFrame:
    """The rows, written and read back."""
    write_table(df, path)
    return read_table(df.sparkSession, path)


def export_csv(df: DataFrame, path: str) -> None:
    """RFC 4180 text with a header; blanks around values are kept."""
    writer = df.write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", "")
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", "false")
    writer.csv(path)


def by_cycle(df: DataFrame, sort: list[str] | None = None) -> DataFrame:
    """Bring a cycle's rows together for writing.

    Cycles differ in size by a factor of hundreds: ``rebalance`` lets adaptive execution split
    a large cycle over many tasks and merge the small ones, so there is neither one giant task
    nor a file per task and cycle.
    """
    balanced = df.hint("rebalance", CYCLE)
    return balanced.sortWithinPartitions(*sort) if sort else balanced


def write_partitioned(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    """One folder per cycle; all cycles of the table are replaced."""
    stage_cycles(df, path, sort).publish()


def replace_cycles(df: DataFrame, path: str, sort: list[str] | None = None, touched: Iterable[int] = ()) -> None:
    """Replace the cycles present in ``df``, and empty those of ``touched`` that have no rows left, all at once.
    Other cycles are not touched."""
    stage_cycles(df, path, sort).publish(touched=[folder_of(c) for c in touched])


def replace_cycle(df: DataFrame, path: str, cycle: int, sort: list[str] | None = None) -> None:
    """Replace one cycle, also with nothing.  Rows of other cycles in ``df`` are left out."""
    sort = [c for c in sort if c != CYCLE] if sort else None
    replace_cycles(df.where(F.col(CYCLE) == cycle), path, sort, [cycle])

"""Row filters, de-duplication and column standardisation."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import capitalize_name, iso_date, transaction_year

CYCLE = "election_cycle"


def is_memo(column: str = "memo_cd") -> Column:
    return F.col(column).eqNullSafe("X")


def is_amended(column: str = "amndt_ind") -> Column:
    """True for a known flag other than ``N``; a missing flag counts as new."""
    return F.col(column).isNotNull() & (F.col(column) != "N")


def exclude_memos(df: DataFrame, column: str = "memo_cd") -> DataFrame:
    return df.where(~is_memo(column))


def exclude_amendments(df: DataFrame, column: str = "amndt_ind") -> DataFrame:
    return df.where(~is_amended(column))


def dedupe(df: DataFrame, key: str = "sub_id", scope: str = "cycle", order: Iterable[str] = ()) -> DataFrame:
    """Keep one row per ``key`` (``scope="cycle"``: per key and cycle; ``"global"``: per key).

    The surviving row is the smallest by ``order``, then by the remaining columns, so the result
    does not depend on file order or partitioning.  ``row_number() = 1`` is limited per map
    task before the shuffle, so a key that holds a large share of the rows leaves one row per
    task.  The key leads the sort because its prefix is selective; the cycle's is not.
    """
    keys = [key] + ([CYCLE] if scope == "cycle" else [])
    columns = dict.fromkeys([*order, *df.columns])
    by = [F.col(c).asc_nulls_first() for c in columns if c not in keys]
    ranked = Window.partitionBy(*keys).orderBy(*(by or [F.lit(0)]))
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def cycle_slice(df: DataFrame, cycle: int) -> DataFrame:
    return df.where(F.col(CYCLE) == cycle)


def standardize_names(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: capitalize_name(c) for c in columns if c in df.columns})


def standardize_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Dates to ISO text; a second run leaves finished values alone."""
    return df.withColumns({c: iso_date(c, keep_iso=True) for c in columns if c in df.columns})


def add_transaction_year(df: DataFrame, force: bool = False, date: str = "transaction_dt") -> DataFrame:
    """Second column ``transaction_year``; an existing one is kept unless ``force``."""
    if "transaction_year" in df.columns and not force:
        return df
    first, *rest = [c for c in df.columns if c != "transaction_year"]
    return df.select(first, transaction_year(date).alias("transaction_year"), *rest)


def changed_values(df: DataFrame, standardized: dict[str, Callable[[Column], Column]], sample: int = 3) -> DataFrame:
    """Sample of (column, before, after) for values a standardisation would change.

    One scan for all columns.  Values are made distinct before they are converted, each is
    converted once, and the first few of a column are picked before the second shuffle.  A conversion is a
    large expression: columns that share one share its code, and unchanged values are dropped inside the array that
    holds the pair, as a filter below would hold the expression a second time.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("before")) for c in standardized])
    distinct = df.select(F.inline(pairs)).where("before IS NOT NULL").distinct()
    shared: dict[Callable[[Column], Column], list[str]] = {}
    for c, convert in standardized.items():
        shared.setdefault(convert, []).append(c)
    after = F.lit(None).cast("string")
    for convert, names in shared.items():
        after = F.when(F.col("column_name").isin(names), convert(F.col("before"))).otherwise(after)
    both = F.array(F.struct("column_name", "before", after.alias("after")))
    changed = distinct.select(F.inline(F.filter(both, lambda r: ~r["before"].eqNullSafe(r["after"]))))
    first = F.row_number().over(Window.partitionBy("column_name").orderBy("before"))
    return changed.withColumn("_rank", first).where(F.col("_rank") <= sample).drop("_rank")

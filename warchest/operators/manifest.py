"""Refresh state: which (dataset, cycle) changed, and what was applied."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..specs import SPECS

KEY = ["dataset", "cycle"]
STATE = ["etag", "last_modified", "content_length"]
LOOKBACK = 4


def current_cycle(year: int | None = None) -> int:
    year = year or datetime.date.today().year
    return year + year % 2


def lookback(df: DataFrame, current: int, start_year: Column, cycle: str = "cycle") -> DataFrame:
    """The current cycle and the two before it, from the dataset's first cycle on."""
    c = F.col(cycle)
    return df.where((c >= current - LOOKBACK) & (c <= current) & (c % 2 == 0) & (c >= start_year))


def refreshable() -> list[str]:
    """Datasets with a file of their own; a second roll-up of a file follows the first."""
    return [n for n, s in SPECS.items() if s.same_file_as is None]


def start_years(spark: SparkSession) -> DataFrame:
    rows = [(n, SPECS[n].start_year) for n in refreshable()]
    return spark.createDataFrame(rows, "dataset string, start_year int")


def _both_differ(new: str, old: str) -> Column:
    """Different values, both known; an empty text and a length of 0 count as unknown."""
    known = lambda c: ~F.coalesce(F.col(c).cast("string"), F.lit("")).isin("", "0")
    return known(new) & known(old) & (F.col(new) != F.col(old))


def manifest_diff(old: DataFrame, new: DataFrame, changed_only: bool = True) -> DataFrame:
    """Reason per (dataset, cycle) of ``new``: first differing fact known on both sides."""
    left = new.select(*KEY, *STATE).alias("n")
    right = old.select(*KEY, *STATE, F.lit(True).alias("seen")).alias("o")
    joined = left.join(right, KEY, "left")
    reason = F.when(F.col("seen").isNull(), "new cycle")
    for fact, text in zip(STATE, ("etag changed", "last-modified changed", "content-length changed")):
        reason = reason.when(_both_differ(f"n.{fact}", f"o.{fact}"), text)
    out = joined.select(*KEY, reason.otherwise("no change").alias("reason"), *[f"n.{c}" for c in STATE])
    return out.where("reason != 'no change'") if changed_only else out


def forced_changes(datasets: DataFrame, cycles: list[int]) -> DataFrame:
    """Every dataset with every listed cycle it covers.  ``datasets`` has (dataset, start_year)."""
    none = F.lit(None)
    listed = F.explode(F.array(*[F.lit(c) for c in cycles]))
    return (
        datasets.select("dataset", "start_year", listed.alias("cycle"))
        .where("cycle >= start_year")
        .select(*KEY, F.lit("forced").alias("reason"), none.cast("string").alias("etag"),
                none.cast("string").alias("last_modified"), none.cast("bigint").alias("content_length"))
    )


def refresh_status(manifest: DataFrame) -> DataFrame:
    """Last update per dataset and cycle, and the newest one of the dataset."""
    per_dataset = manifest.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("cycles"), F.max("last_updated").alias("dataset_updated"))
    return manifest.join(per_dataset, "dataset").select(
        "dataset", "cycle", F.coalesce("last_updated", F.lit("unknown")).alias("last_updated"),
        "cycles", "dataset_updated")

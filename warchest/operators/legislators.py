"""Nested legislator records: merge, unnest, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import term_in_range
from ..functions.matching import FIRST_CYCLE, LAST_CYCLE

BIOGUIDE = "id.bioguide"


def has_text(c: Column | str) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def merge_legislators(historical: DataFrame, current: DataFrame) -> DataFrame:
    """One record per legislator; the current file wins over the historical one."""
    both = historical.withColumn("_source", F.lit(0)).unionByName(current.withColumn("_source", F.lit(1)))
    latest = Window.partitionBy(BIOGUIDE).orderBy(
        F.col("_source").desc(), *[F.col(c).desc_nulls_last() for c in historical.columns]
    )
    return (
        both.where(has_text(BIOGUIDE))
        .withColumn("_rank", F.row_number().over(latest))
        .where("_rank = 1")
        .drop("_rank", "_source")
    )


def most_recent_first(df: DataFrame) -> DataFrame:
    """Source files list terms oldest first; everything else here expects the reverse."""
    return df.withColumn("terms", F.reverse("terms"))


def terms_in_range(df: DataFrame, low: int = FIRST_CYCLE, high: int = LAST_CYCLE) -> DataFrame:
    """Keep the terms that overlap the years, and the legislators that have one."""
    inside = F.filter("terms", lambda t: term_in_range(t["start"], t["end"], low, high))
    return df.withColumn("terms", inside).where(F.size("terms") > 0)


def has_candidate_ids() -> Column:
    return F.coalesce(F.size("id.fec") > 0, F.lit(False))


def legislator_stats(df: DataFrame) -> DataFrame:
    """Counts by party and chamber of the most recent term, and of those with candidate ids."""
    latest = F.get("terms", F.lit(0))
    chamber = F.when(latest["type"] == "sen", "Senate").when(latest["type"] == "rep", "House").otherwise("Unknown")
    facts = F.array(
        F.struct(F.lit("party").alias("metric"), F.coalesce(latest["party"], F.lit("Unknown")).alias("value")),
        F.struct(F.lit("chamber").alias("metric"), chamber.alias("value")),
        F.struct(
            F.lit("candidate_ids").alias("metric"),
            F.when(has_candidate_ids(), "with").otherwise("without").alias("value"),
        ),
    )
    return (
        df.select(F.explode(facts).alias("f"))
        .groupBy("f.metric", "f.value")
        .agg(F.count(F.lit(1)).alias("legislators"))
    )

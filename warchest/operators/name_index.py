"""Substring search over committee names by an inverted index of trigrams.

The index is one stored table with two kinds of rows, so that a rebuild becomes visible in one step: registrations, and postings
(three characters of a lower-case name, the name's hash).  Both are dealt into a fixed number of folders, registrations by the hash
of their name and postings by their characters, sorted within.  A search reads the folders of its trigrams, keeps the names that
have all of them, reads the registrations of those names, and lets the report itself decide: hits are verified, so the rows are
those of the scan.  Texts without three characters in a row between wildcards have no trigram; they are searched by a scan of the
registrations.  A trigram that many names have is a long posting list, read and counted by many tasks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import reports
from ..sources.tables import read_table
from ..sources.versions import VersionedTable
from .clean import CYCLE

GRAM = 3
PARTS = 32
REGISTRATION = (CYCLE, "cmte_id", "cmte_nm", "cmte_tp")


def _folder(kind: str, value: str | Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.pmod(F.xxhash64(value), F.lit(PARTS)).cast("string"))


def postings(names: DataFrame) -> DataFrame:
    """(gram, key): the distinct trigrams of the distinct names in ``cmte_nm``."""
    low = F.lower("cmte_nm")
    starts = F.sequence(F.lit(1), F.greatest(F.char_length(low) - GRAM + 1, F.lit(1)))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, F.lit(GRAM))))
    out = names.where("cmte_nm IS NOT NULL").select("cmte_nm").distinct()
    out = out.select(F.explode(grams).alias("gram"), F.xxhash64("cmte_nm").alias("key"))
    return out.where(F.char_length("gram") == GRAM)


def write_index(committees: DataFrame, path: str) -> None:
    """Build or replace the index of a table of registrations."""
    rows = committees.where("cmte_nm IS NOT NULL").select(*REGISTRATION)
    kept = rows.select(F.lit(None).cast("string").alias("gram"), F.xxhash64("cmte_nm").alias("key"), *REGISTRATION, _folder("row", "cmte_nm").alias("part"))
    listed = postings(rows).withColumn("part", _folder("gram", "gram"))
    both = kept.unionByName(listed, allowMissingColumns=True)
    dealt = both.hint("rebalance", "part").sortWithinPartitions("part", "gram", "key")
    VersionedTable(committees.sparkSession, path).stage(dealt, "part").publish()


def grams_of(spark: SparkSession, text: str) -> list[str]:
    """The trigrams that every name with ``text`` in it must have, in Spark's lower case."""
    low = spark.range(1).select(F.lower(F.lit(f"%{text}%"))).first()[0]
    return sorted({piece[i : i + GRAM] for piece in re.split("[%_]", low) for i in range(len(piece) - GRAM + 1)})


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """Registrations whose names may contain ``text``; all of them if it has no trigram."""
    stored = read_table(spark, path)
    rows = stored.where(F.col("part").startswith("row-"))
    grams = grams_of(spark, text)
    if grams:
        folders = [r.part for r in spark.createDataFrame([(g,) for g in grams], "gram string").select(_folder("gram", "gram").alias("part")).distinct().collect()]
        listed = stored.where(F.col("part").isin(folders) & F.col("gram").isin(grams))
        names = listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams))
        # the folder is part of the join, so that folders without a candidate are not read
        wanted = names.select("key", F.concat(F.lit("row-"), F.pmod("key", F.lit(PARTS)).cast("string")).alias("part"))
        rows = rows.join(wanted, ["part", "key"], "left_semi")
    return rows.select(*REGISTRATION)


def indexed_search(spark: SparkSession, path: str, text: str, k: int = 50) -> DataFrame:
    """``committee_search`` over an index: the same rows."""
    return reports.committee_search(candidates(spark, path, text), text, k)

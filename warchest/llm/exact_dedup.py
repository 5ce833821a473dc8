"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by successive bytes of their text, most significant first; the length of a text stands before its first byte.  A round takes the next digit (64 bytes, then
16 times as many each round) within each group and counts the groups (combined per task before the shuffle).  A group of one
row is done; a group whose digit is shorter than the round's width has ended, so its texts are equal; the others go to the next round
with the rest of their text.  No digest decides equality.  Rounds grow with the logarithm of the longest text.  Rows meet
their group in a merge join that adaptive execution splits, so a text that a third of the rows share is no single task; the groups
grow with the data and are never broadcast.

Results: a missing text counts as empty.  The row with the largest id stays; a missing id is smaller than any other.  Of rows
that repeat id and text one stays.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from warchest.llm.common import col, spool

WIDTH = 64
GROWTH = 16


def exact_duplicates(df: DataFrame, *, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, growth: int = GROWTH) -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256."""
    data = F.coalesce(col(text), F.lit("")).cast("binary")
    rows = df.select(col(doc_id).alias("doc_id"), data.alias("rest"), F.unhex(F.sha2(data, 256)).alias("sha"), F.octet_length(data).cast("long").alias("group"))
    done: list[DataFrame] = []
    while True:
        digit, rest = F.substring("rest", 1, width), F.expr(f"substring(rest, {width + 1})")
        split = rows.select("doc_id", "sha", "group", digit.alias("digit"), rest.alias("rest"))
        groups = split.groupBy("group", "digit").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep"))
        groups = groups.where("n > 1").withColumn("next", F.monotonically_increasing_id())
        groups = spool(groups, "groups")  # written, so the numbers stay
        met = split.join(groups.hint("merge"), ["group", "digit"], "left")
        open_ = F.col("n").isNotNull() & (F.length("digit") == width)
        met = met.select(
            "doc_id", "sha", F.when(open_, F.col("rest")).alias("rest"), F.col("next").alias("group"),
            F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
            F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), open_.alias("open"),
        )
        met = spool(met, "radix", "open")
        done.append(met.where("not open").select("doc_id", "keep_id", "group_size", "sha", "group"))
        rows = met.where("open").select("doc_id", "rest", "sha", "group")
        if rows.isEmpty():
            break
        width *= growth
    found = reduce(DataFrame.unionAll, done)
    # rows that repeat id and text are counted and written out again, one of them kept
    found = found.groupBy("doc_id", "keep_id", "group_size", "sha").agg(F.count(F.lit(1)).alias("times"))
    found = found.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("k"))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("k") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )

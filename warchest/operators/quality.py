"""Table validation: one aggregate per table, issues as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import CYCLE

EXTREME_AMOUNT = 1_000_000_000_000

PROFILE_SCHEMA = (
    "table_name string, row_count bigint, column_count int, has_election_cycle boolean, "
    "null_election_cycle bigint, min_cycle int, max_cycle int, issues array<string>"
)


def _count_text(n: Column) -> Column:
    return F.format_number(n, 0)


def amount_check(df: DataFrame) -> DataFrame:
    """Rows with extreme totals and rows with a non-positive count."""
    return df.agg(
        F.count_if(F.abs("total_amount") > EXTREME_AMOUNT).alias("extreme_rows"),
        F.count_if(F.col("transaction_count") <= 0).alias("nonpositive_rows"),
    )


def table_profile(df: DataFrame, name: str, amounts: bool = True) -> DataFrame:
    """Row and column counts, cycle range and issues of one table, from a single pass.

    A table with missing cycles reports no smallest cycle, as its cycles sort missing first.
    """
    has_cycle = CYCLE in df.columns
    cycle = F.col(CYCLE).cast("int") if has_cycle else F.lit(None).cast("int")
    check_total = amounts and "total_amount" in df.columns
    check_count = check_total and "transaction_count" in df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.count_if(cycle.isNull()) if has_cycle else F.lit(0).cast("bigint")).alias("null_election_cycle"),
        F.min(cycle).alias("low"),
        F.max(cycle).alias("max_cycle"),
        (F.count_if(F.abs("total_amount") > EXTREME_AMOUNT) if check_total else F.lit(0)).alias("extreme"),
        (F.count_if(F.col("transaction_count") <= 0) if check_count else F.lit(0)).alias("nonpositive"),
    )
    nulls, extreme, nonpositive = F.col("null_election_cycle"), F.col("extreme"), F.col("nonpositive")
    found = F.array(
        F.lit(None if has_cycle else "Missing election_cycle column"),
        F.when(nulls > 0, F.concat(_count_text(nulls), F.lit(" null election_cycle values"))),
        F.when(F.col("row_count") == 0, "File is empty"),
        F.when(extreme > 0, F.concat(extreme.cast("string"), F.lit(" rows with amounts > $1 trillion"))),
        F.when(nonpositive > 0,
               F.concat(nonpositive.cast("string"), F.lit(" rows with zero/negative transaction_count"))),
    )
    return counts.select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(has_cycle).alias("has_election_cycle"),
        nulls,
        F.when(nulls == 0, F.col("low")).alias("min_cycle"),
        "max_cycle",
        F.array_compact(found).alias("issues"),
    )


def missing_table(spark: SparkSession, name: str) -> DataFrame:
    row = (name, 0, 0, False, 0, None, None, ["File not found"])
    return spark.createDataFrame([row], PROFILE_SCHEMA)


def quality_report(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Profile of every table; a table that is not there is a row with an issue."""
    out = None
    for name, df in tables.items():
        part = missing_table(spark, name) if df is None else table_profile(df, name)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("is_valid", F.size("issues") == 0)


def quality_issues(report: DataFrame) -> DataFrame:
    return report.select("table_name", F.explode("issues").alias("issue"))


def key_uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def raw_value_audit(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Per numeric column of ``schema``, over the same columns read as text: values that are there,
    values that no number can be made of, and values that lose decimals.  One pass."""
    numbers = [f for f in schema if isinstance(f.dataType, T.NumericType) and f.name in text.columns]
    facts = []
    for f in numbers:
        value = F.trim(f.name)
        there = value != ""
        typed = value.try_cast(f.dataType)
        exact = value.try_cast("decimal(38,12)")
        facts += [
            F.count_if(there).alias(f"{f.name} filled"),
            F.count_if(there & typed.isNull()).alias(f"{f.name} unparsed"),
            F.count_if(there & typed.isNotNull() & (exact != typed)).alias(f"{f.name} rounded"),
        ]
    counted = text.agg(*facts)
    rows = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), *[F.col(f"`{f.name} {k}`").alias(k) for k in ("filled", "unparsed", "rounded")])
        for f in numbers
    ])
    return counted.select(F.inline(rows))


def width_audit(lines: DataFrame, width: int, sep: str = "|") -> DataFrame:
    """Per file: lines, and lines with fewer or more fields than ``width``."""
    fields = F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit(""))) + 1
    return lines.where("value != ''").groupBy("file", CYCLE).agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(fields < width).alias("short_lines"), F.count_if(fields > width).alias("long_lines"))


def required_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of missing values per required column."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_rows")


def out_of_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value is known and outside the expected range."""
    return df.where(~F.col(column).between(low, high))


def cycle_counts(df: DataFrame, last: int | None = None) -> DataFrame:
    """Rows per cycle; ``last`` keeps the most recent cycles."""
    counts = df.groupBy(CYCLE).agg(F.count(F.lit(1)).alias("row_count"))
    return counts if last is None else counts.orderBy(F.col(CYCLE).desc()).limit(last)

"""Landed lines as typed rows and, apart from them, the rejected lines: which file, which line, why.

One scan parses every line.  A line whose number of fields is wrong, or with text where a number belongs, is rejected with all its
reasons and its text; blank lines are neither.  Both kinds are written by one job.  Line numbers come from what that job wrote: a file is
read in blocks, rows know their block and their turn in it, and the blocks' line counts, a few rows a file, give where each begins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import CYCLE
from ..specs import DatasetSpec
from .files import cycle_of_file, landing_glob
from .tables import write_table
from .versions import VersionedTable

REASONS, REJECTED = "reasons", "rejected"
_FILE, _BLOCK, _TURN, _LINE = "_file", "_block", "_turn", "_line"
_PLACE = [_FILE, _BLOCK, _TURN]
#: Kinds of faults, each with its reasons.
FIELDS, NUMBERS = "fields", "numbers"
SHORT, LONG, BLANK = "too few fields", "too many fields", "blank line"


def read_lines(spark: SparkSession, landing: str, spec: DatasetSpec, cycle: int | None = None) -> DataFrame:
    """(cycle, _line, and its place) of the family's files."""
    lines = spark.read.option("pathGlobFilter", landing_glob(spec, cycle)).option("recursiveFileLookup", "true").text(landing)
    return lines.select(
        cycle_of_file().alias(CYCLE), F.col("value").alias(_LINE), F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_BLOCK), F.monotonically_increasing_id().alias(_TURN))


def parse(lines: DataFrame, schema: T.StructType, faults: tuple[str, ...] = (FIELDS, NUMBERS)) -> DataFrame:
    """Cycle, the typed columns, `reasons`, `rejected`, the text of rejected lines, and the place.

    Typed values are those of ``read_pipe``; ``faults`` are the kinds that reject a line.
    """
    options = {"sep": "|", "quote": "", "mode": "PERMISSIVE"}
    record = F.from_csv(F.col(_LINE), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), options)
    rows = lines.withColumns({"_fields": F.split(_LINE, r"\|", -1), "_record": record})
    blank = F.trim(_LINE) == ""
    reasons = []
    if FIELDS in faults:
        width = F.size("_fields")
        reasons += [F.when(width < len(schema), SHORT), F.when(width > len(schema), LONG)]
    if NUMBERS in faults:
        for i, f in enumerate(schema):
            if isinstance(f.dataType, T.NumericType):
                text = F.trim(F.get("_fields", F.lit(i)))
                reasons.append(F.when((text != "") & F.col(f"_record.{f.name}").isNull(), F.lit(f"unreadable {f.name}")))
    found = F.when(blank, F.array(F.lit(BLANK))).otherwise(F.array_compact(F.array(*reasons, F.lit(None).cast("string"))))
    rows = rows.withColumn(REASONS, found).withColumn(REJECTED, F.size(REASONS) > 0)
    return rows.select(
        CYCLE, *[F.col(f"_record.{f.name}").alias(f.name) for f in schema], REASONS,
        F.when(F.col(REJECTED), F.col(_LINE)).alias(_LINE), *_PLACE, REJECTED)


def numbered(rows: DataFrame) -> DataFrame:
    """Rejected rows with the number of their line in the file, from 1.  `rows` holds every line of the files."""
    blocks = rows.groupBy(_FILE, _BLOCK).agg(F.min(_TURN).alias("_first"), (F.max(_TURN) - F.min(_TURN) + 1).alias("_count"))
    before = Window.partitionBy(_FILE).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("_start", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    # a row a block; without the hint the lines are shuffled before Spark knows how few these are
    rejected = rows.where(REJECTED).join(F.broadcast(starts), [_FILE, _BLOCK])
    return rejected.select(
        F.col(_FILE).alias("file"), (F.col("_start") + F.col(_TURN) - F.col("_first") + 1).alias("line_number"), CYCLE,
        REASONS, F.col(_LINE).alias("line")).where(~F.array_contains(REASONS, BLANK))


@dataclass(frozen=True)
class Stored:
    """Tables of a landed family."""

    rows: str
    rejected: str


def store(spark: SparkSession, landing: str, spec: DatasetSpec, path: str, cycle: int | None = None,
          faults: tuple[str, ...] = (FIELDS, NUMBERS)) -> Stored:
    """Typed rows at ``path``, rejected lines at ``path.rejected``.  The files are read once; both tables come from that job."""
    rows = parse(read_lines(spark, landing, spec, cycle), spec.raw_schema, faults)
    table = VersionedTable(spark, path)
    staged = table.stage(rows, REJECTED)
    try:
        write_table(numbered(staged.read()), f"{path}.rejected", ["file", "line_number"])
    except Exception:
        staged.discard()
        raise
    kept = {k: f for k, f in staged.folders().items() if k == f"{REJECTED}=false"}
    table.publish(rows.select(CYCLE, *spec.raw_schema.names).schema, kept, table.current())
    return Stored(path, f"{path}.rejected")


def summary(rejected: DataFrame) -> DataFrame:
    """Rejected lines per cycle and reason."""
    return rejected.select(CYCLE, F.explode(REASONS).alias("reason")).groupBy(CYCLE, "reason").agg(F.count(F.lit(1)).alias("n_lines"))

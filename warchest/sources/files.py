"""Readers.  Every schema is explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import CYCLE
from ..operators.combine import snake_case
from ..specs import LEGISLATOR, DatasetSpec


def any_case(text: str) -> str:
    """Glob that matches ``text`` in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in text)


def landing_glob(spec: DatasetSpec, cycle: int | None = None) -> str:
    """Files of a family, of one cycle if given: ``{cycle}_{prefix}{yy}.txt``."""
    year = "[0-9][0-9][0-9][0-9]" if cycle is None else str(cycle)
    short = "[0-9][0-9]" if cycle is None else f"{cycle % 100:02d}"
    return f"{year}_{any_case(spec.prefix)}{short}.{any_case('txt')}"


def cycle_of_file(file_name: Column | None = None) -> Column:
    """Cycle in front of a file name, as in ``2024_oth24.txt``."""
    name = F.col("_metadata.file_name") if file_name is None else file_name
    return F.regexp_extract(name, r"\A([0-9]{4})_", 1).try_cast("int")


def read_pipe(spark: SparkSession, path: str | list[str], schema: T.StructType, glob: str | None = None,
              with_cycle: bool = True) -> DataFrame:
    """Headerless ``|`` files.  Quotes are plain text, extra fields are dropped, missing ones
    are NULL, values that do not fit their type are NULL, bad bytes become U+FFFD."""
    reader = (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("quote", "")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("encoding", "UTF-8")
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    df = reader.csv(path)
    return df.select(cycle_of_file().alias(CYCLE), *schema.names) if with_cycle else df


def read_dataset(spark: SparkSession, landing: str, spec: DatasetSpec, cycle: int | None = None) -> DataFrame:
    return read_pipe(spark, landing, spec.raw_schema, landing_glob(spec, cycle))


def read_raw_text(spark: SparkSession, landing: str, spec: DatasetSpec, cycle: int | None = None) -> DataFrame:
    """The same files with every column as it was delivered."""
    plain = T.StructType([T.StructField(c, T.StringType()) for c in spec.columns])
    return read_pipe(spark, landing, plain, landing_glob(spec, cycle))


def read_lines(spark: SparkSession, landing: str, glob: str) -> DataFrame:
    """(file, cycle, value): the raw lines of landed files."""
    lines = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(landing)
    return lines.select(F.col("_metadata.file_name").alias("file"), cycle_of_file().alias(CYCLE), "value")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """RFC 4180 files with a header; columns are found by name.

    The header gives the order: a column the schema does not name is skipped, one the file does
    not have is NULL.  A further file whose header differs fails.  ``columns`` reaches the parser
    as a pruned schema.
    """
    wanted = schema if columns is None else T.StructType([schema[c] for c in columns])
    reader = spark.read.option("header", "true").option("escape", '"')
    header = reader.csv(path).columns
    known = {f.name: f.dataType for f in schema}
    layout = T.StructType([T.StructField(c, known.get(c, T.StringType())) for c in header])
    df = reader.schema(layout).option("enforceSchema", "false").csv(path) if header else spark.createDataFrame([], wanted)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])


def read_text_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text."""
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_headers(spark: SparkSession, path: str) -> list[str]:
    """Column names from a one-line header file."""
    line = spark.read.text(path).first()
    return [h.strip().lower() for h in line.value.strip().split(",")] if line else []


def read_with_headers(spark: SparkSession, path: str, header_path: str, glob: str | None = None) -> DataFrame:
    headers = read_headers(spark, header_path)
    raw = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(headers))])
    return snake_case(read_pipe(spark, path, raw, glob), [CYCLE, *headers])


def read_legislators(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Nested legislator records.  One record per line splits across tasks; a published JSON
    array needs ``multi_line``."""
    return spark.read.schema(LEGISLATOR).option("multiLine", str(multi_line).lower()).json(path)


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """JSON map of name -> {bioguide_id, display_name} as rows."""
    entry = "map<string, struct<bioguide_id: string, display_name: string>>"
    parsed = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", entry)).alias("name", "e"))
    return parsed.select("name", "e.bioguide_id", "e.display_name")

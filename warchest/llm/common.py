"""What the operators of this folder share: tables, scratch tables, folds, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from warchest.session import shared_dir

#: A word is a run of characters that are no ASCII white space.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def fold(doc_id: Column, parts: int, which: int) -> Column:
    """True where crc32 of the id's text leaves `which`; false for a missing id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts)) == which, F.lit(False))


#: Tables that spool has written and release has not yet removed.
SPOOLED: list[str] = []


def spool(df: DataFrame, label: str, *by: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    SPOOLED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Remove what spool wrote so far.  Call it once the results that read it are stored."""
    while SPOOLED:
        _remove(spark, SPOOLED.pop())


def tidy(spark: SparkSession, since: int, *kept: DataFrame | None) -> None:
    """Remove what spool wrote since SPOOLED had `since` entries, but for the tables that `kept` reads."""
    # files come back with other forms of the same address, the folder's own name is unique
    read = {part for df in kept if df is not None for f in df.inputFiles() for part in f.split("/")}
    for name in SPOOLED[since:]:
        if name.rpartition("/")[2] not in read:
            _remove(spark, name)
            SPOOLED.remove(name)


def slices(batch: pa.RecordBatch, column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose texts have at most `limit` bytes, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    df: DataFrame, text: str, keep: list[str], made: list[T.StructField],
    start: Callable[[], Callable[[list], list[list]]], *, binary: bool = False, limit: int = 2 << 20,
) -> DataFrame:
    """The columns `keep` of every row, and columns made of its text.  `start` is called once a task and returns
    a function from a list of texts (bytes if `binary`; None if missing) to the lists of the made columns."""
    source = df.select(col(text).cast("binary" if binary else "string").alias("\0text"), *[col(c) for c in keep])
    schema = T.StructType([*source.schema.fields[1:], *made])
    kinds = list(to_arrow_schema(T.StructType(made)).types)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for part in slices(batch, 0, limit):
                values = work(part.column(0).to_pylist())
                arrays = [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *arrays], names=names)

    return source.mapInArrow(run, schema)

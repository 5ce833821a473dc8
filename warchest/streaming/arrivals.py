"""A log of file deliveries, for streams that must see a file again when it is delivered again under its old name.

Spark's file source knows a path, not what was delivered there, so an overwritten file is never seen.  Here the landing folder is
listed, the listing is compared with the newest version of every path in the log, and the differences are appended: a new file, one
with another time or length, and one that is gone.  The log is a folder of small files, each written once, so the file source
that reads it has durable offsets: a batch names exactly its versions, and a replay names them again.  Two listings that notice the
same version write it twice, which costs a rebuild and changes nothing.
"""

from __future__ import annotations

import logging
import threading

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.clean import CYCLE
from ..operators.manifest import _both_differ
from ..sources.files import cycle_of_file, landing_glob
from ..specs import DatasetSpec

log = logging.getLogger(__name__)

LOG_SCHEMA = "path string, last_modified string, content_length bigint, version bigint, reason string"
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def listing(spark: SparkSession, landing: str, spec: DatasetSpec) -> DataFrame:
    """(path, last_modified, content_length) of landed files, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", landing_glob(spec)).option("recursiveFileLookup", "true").load(landing)
    return files.select("path", F.date_format("modificationTime", _TIME).alias("last_modified"), F.col("length").alias("content_length"))


def newest(deliveries: DataFrame) -> DataFrame:
    """The newest version of every path."""
    last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("version"), F.desc("last_modified")))
    return deliveries.withColumn("_rank", last).where("_rank = 1").drop("_rank")


def differences(known: DataFrame, listed: DataFrame) -> DataFrame:
    """Deliveries of ``listed`` that ``known`` does not hold, as rows of the log."""
    old = newest(known).select("path", F.col("version").alias("seen"), F.col("reason").alias("was"),
                               *[F.col(c).alias(f"old_{c}") for c in ("last_modified", "content_length")])
    both = listed.withColumn("there", F.lit(True)).join(old, "path", "full_outer")
    gone = F.col("there").isNull()
    reason = (
        F.when(gone & (F.col("was") != "gone"), "gone")
        .when(F.col("there") & (F.col("seen").isNull() | (F.col("was") == "gone")), "new file")
        .when(F.col("there") & _both_differ("last_modified", "old_last_modified"), "last-modified changed")
        .when(F.col("there") & (F.col("content_length") != F.col("old_content_length")), "content-length changed")
    )
    version = (F.coalesce("seen", F.lit(0)) + 1).alias("version")
    return both.select("path", "last_modified", "content_length", version, reason.alias("reason")).where("reason IS NOT NULL")


def notice(spark: SparkSession, landing: str, spec: DatasetSpec, deliveries: str) -> None:
    """Append what changed in the landing folder since the last call.  The listing holds names, never contents."""
    empty = spark.createDataFrame([], LOG_SCHEMA)
    empty.write.mode("append").json(deliveries)  # makes the folder
    found = differences(spark.read.schema(LOG_SCHEMA).json(deliveries), listing(spark, landing, spec))
    # the difference is read and written in one job, so it is the same one
    found.coalesce(1).write.mode("append").json(deliveries)


def stream(spark: SparkSession, deliveries: str) -> DataFrame:
    """Stream of (path, version, reason, cycle) of the log."""
    rows = spark.readStream.schema(LOG_SCHEMA).json(deliveries)
    return rows.select("path", "version", "reason", cycle_of_file(F.element_at(F.split("path", "/"), -1)).alias(CYCLE))


class Watch:
    """Calls ``notice`` again and again while a query runs."""

    def __init__(self, spark: SparkSession, landing: str, spec: DatasetSpec, deliveries: str, seconds: float = 60) -> None:
        self._args, self._seconds, self._end = (spark, landing, spec, deliveries), seconds, threading.Event()

    def follow(self, query) -> None:
        self._thread = threading.Thread(target=self._run, args=(query,), daemon=True)
        self._thread.start()

    def _run(self, query) -> None:
        while query.isActive and not self._end.wait(self._seconds):
            try:
                notice(*self._args)
            except Exception as error:  # noqa: BLE001 - a listing that fails is tried again
                log.warning("listing of %s failed: %s", self._args[1], error)

    def stop(self) -> None:
        self._end.set()

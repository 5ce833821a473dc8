"""Ingest of landed files as a stream of deliveries.

The stream carries file names only, never file contents: the log of ``arrivals`` names new files, files delivered again under
their name, and files that are gone.  Each micro-batch names the cycles concerned; those are rebuilt from everything landed
for them and replace their partitions, in every table made of the files.  Replaying a batch writes the same partitions
again, so a restart after a failure needs no other bookkeeping.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import CYCLE
from ..plans.refresh import store_cycles
from ..sources.files import landing_glob, read_pipe
from ..specs import DatasetSpec
from . import arrivals


def cycle_ingest(spark: SparkSession, landing: str, spec: DatasetSpec, table: str, checkpoint: str,
                 available_now: bool = True, seconds: float = 60) -> StreamingQuery:
    """Keep ``table`` up to date, and the tables that share the family's files, in folders next to it.

    ``available_now`` handles what is landed and ends; otherwise the landing folder is listed every ``seconds``.
    """
    def rebuild(batch: DataFrame, _: int) -> None:
        cycles = [r[0] for r in batch.select(CYCLE).where(F.col(CYCLE).isNotNull()).distinct().collect()]
        if not cycles:
            return
        session = batch.sparkSession
        globs = "{" + ",".join(landing_glob(spec, c) for c in sorted(cycles)) + "}"
        raw = read_pipe(session, landing, spec.raw_schema, globs)
        store_cycles(raw, spec, table, cycles)

    root = checkpoint.rstrip("/")
    deliveries = f"{root}-deliveries"
    arrivals.notice(spark, landing, spec, deliveries)
    writer = (
        arrivals.stream(spark, deliveries)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", root)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    query = writer.start()
    if not available_now:
        arrivals.Watch(spark, landing, spec, deliveries, seconds).follow(query)
    return query

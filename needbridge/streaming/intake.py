"""Incremental intake of submission files (Structured Streaming).

Sources submit at different cadences.  New raw files landing in a
directory are typed with the same staging operator as the batch path and
appended to a staged table; the query's checkpoint (on shared storage)
records which files were done, so a restarted or failed run picks up
exactly the files it has not written yet.  Staging is a stateless
projection, so no streaming state is kept; deduplication of resubmitted
records stays the batch step over the accumulated table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from needbridge.operators import stage_members, stage_renewals, stage_screenings, stage_services
from needbridge.schemas import RAW_SCHEMAS

STAGERS = {
    "members": stage_members,
    "screenings": stage_screenings,
    "services": stage_services,
    "renewals": stage_renewals,
}


def staged_stream(spark: SparkSession, kind: str, source_dir: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of staged rows from raw Parquet files in ``source_dir``."""
    reader = spark.readStream.schema(RAW_SCHEMAS[kind])
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return STAGERS[kind](reader.parquet(source_dir))


def start_intake(spark: SparkSession, kind: str, source_dir: str, sink_dir: str,
                 checkpoint_location: str, available_now: bool = True,
                 processing_time: str = "1 minute") -> StreamingQuery:
    """Append staged rows to Parquet at ``sink_dir``.

    ``available_now`` processes every file present at start and stops
    (scheduled runs); otherwise the query keeps running on a timer.
    """
    w = (staged_stream(spark, kind, source_dir).writeStream.format("parquet")
         .option("path", sink_dir).option("checkpointLocation", checkpoint_location)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()

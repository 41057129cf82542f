"""Incremental landing: feed pages land as files over time, the stream turns
each new batch of pages into landing rows.

This is the landing stage (J-1) run as Structured Streaming instead of a
crawl loop that accumulates pages in driver memory: the parquet file source
picks up newly landed page files, ``from_xml`` + ``explode`` run on
executors, and the file sink appends to the partitioned landing zone with
exactly-once commits recorded under the checkpoint location. Stateless, so
no watermark is needed; ``availableNow`` processes what has landed and stops.

Readers list the sink's files through its ``_spark_metadata`` log, so the
stream's output folder must be its own: files written there by batch jobs
would be ignored. Each micro-batch adds small files; the bronze job reads
and rewrites them into sized files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from revmart.plans.jobs import landing_frame
from revmart.schemas import LANDING_PARTITIONS, PAGE_SCHEMA


def start_landing_stream(
    spark: SparkSession,
    pages_dir: str,
    out_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    mode: str = "FAILFAST",
) -> StreamingQuery:
    """Start the stream; call ``awaitTermination()`` / ``processAllAvailable()``.

    Only ``FAILFAST``: a permissive stream would drop the entries of a
    malformed page without a trace. Pages that need quarantining go through
    ``landing_job(..., mode="PERMISSIVE", quarantine_path=...)``.
    """
    if mode != "FAILFAST":
        raise ValueError("the landing stream parses FAILFAST; quarantine bad pages with landing_job")
    pages = (
        spark.readStream.schema(PAGE_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(pages_dir)
        .select("page_url", "xml")
    )
    writer = (
        landing_frame(pages, mode)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_path)
        .partitionBy(*LANDING_PARTITIONS)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_path)

"""Structured Streaming ingest of landed indicator payloads (S1 as a stream).

New payload files dropped into a landing folder are parsed with exactly the
batch code (``indicators.parse_payloads`` is projections + explode, so it is
stream-safe) and appended to a Parquet table.  The checkpoint location lives
under the session's shared checkpoint folder, so a restarted query resumes
where it stopped and every file is processed exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cadence.sources import files as FS
from cadence.sources.indicators import parse_payloads


def payload_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of parsed records from text files in ``landing_dir``."""
    texts = (spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger)
             .load(landing_dir))
    return parse_payloads(texts)


def start_ingest(spark: SparkSession, landing_dir: str, table_dir: str, checkpoint_dir: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Append parsed records to ``table_dir`` (Parquet, partitioned by period)."""
    ckpt = checkpoint_dir or FS.scratch_path(spark, "payload-stream-ckpt")
    writer = (payload_stream(spark, landing_dir).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).partitionBy("period"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(table_dir)


def ingest_available(spark: SparkSession, landing_dir: str, table_dir: str,
                     checkpoint_dir: str | None = None) -> DataFrame:
    """Process every file currently landed, then read the table back."""
    q = start_ingest(spark, landing_dir, table_dir, checkpoint_dir, available_now=True)
    q.awaitTermination()
    return spark.read.parquet(table_dir)

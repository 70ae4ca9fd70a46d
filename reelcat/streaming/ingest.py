"""C1 as a stream: dumps landing in a folder are parsed as they arrive.

The reference ingests one dump per run. The same operators run unchanged on a
Structured Streaming file source: each micro-batch of new files is classified
and its rows written under ``batch_id=<n>`` of the videos table and the rejects
table, by overwriting: a batch that is run again replaces what it left before, so
each entry is stored once. The stream keeps no state of its own; last-wins
dedup (A1) stays a read-time view over the stored entry order, so a late dump
of an old id is handled the same way as in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelcat.functions.grammar import RECORD_TERMINATOR
from reelcat.functions.text import decoded_path
from reelcat.operators.dedup import keep_last
from reelcat.operators.parse import classify_entries, parsed_rows, rejected_rows
from reelcat.schemas import VIDEOS_STORED


def read_dump_stream(spark: SparkSession, landing: str, glob: str = "*.txt", max_files: int = 100) -> DataFrame:
    """New dump files under ``landing`` as a stream of raw entries.

    ``source_seq`` (position within a split) is added per micro-batch, where
    the batch is a plain scan of its files.
    """
    raw = (spark.readStream.format("text").option("lineSep", RECORD_TERMINATOR)
           .option("pathGlobFilter", glob).option("maxFilesPerTrigger", max_files).load(landing))
    return raw.select(
        F.col("value"),
        decoded_path("_metadata.file_name").alias("source_name"),
        decoded_path("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_offset"),
    )


def start_ingest(spark: SparkSession, landing: str, videos_path: str, rejects_path: str, checkpoint: str,
                 channel: str | None = None, trigger_once: bool = False) -> StreamingQuery:
    """Start the streaming ingest; each micro-batch appends parsed rows and rejects.

    ``source_seq`` is only increasing within a batch's split, so the batch id
    is stored too: order = (batch, file, split start, seq).
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("source_seq", F.monotonically_increasing_id())
        classified = classify_entries(numbered, channel=channel)
        parsed_rows(classified).write.mode("overwrite").partitionBy("youtuber").parquet(f"{videos_path}/batch_id={batch_id}")
        rejected_rows(classified).write.mode("overwrite").json(f"{rejects_path}/batch_id={batch_id}")

    writer = (read_dump_stream(spark, landing).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="30 seconds")
    return writer.start()


def latest_videos(spark: SparkSession, videos_path: str) -> DataFrame:
    """A1 over everything ingested so far: one row per id, the last entry wins."""
    v = spark.read.schema(VIDEOS_STORED + ", batch_id long").parquet(videos_path)
    return keep_last(v, "id", ["batch_id", "source_file", "source_offset", "source_seq"])

"""The packet pipeline as Structured Streaming queries.

Producers drop text files of packet lines into ``input_dir``; the file
source picks up new files per micro-batch.  ``live=False`` processes what is
there and stops (``availableNow``), which is what tests and backfills use;
``live=True`` runs micro-batches every ``batch_interval``.

Recovery: the checkpoint folder records which files each batch consumed
and which batches committed.  A restarted query (new driver, lost
executors) resumes after the last committed batch; a rerun on the same
checkpoint with no new files adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tessera.functions.scalars import frame_file_name
from tessera.operators.frames import (
    END_MARKER, arrival_number, decode_packets, latest_per_id, parse_packets, until_end,
)
from tessera.sources.frame_files import register as register_frame_files
from tessera.sources.frame_files import write_frame_files
from tessera.sources.packets import LINE_SCHEMA
from tessera.streaming.tail_source import growing_lines

BATCH_INTERVAL = "1 second"
#: Rate of a backlog: bytes of files that one micro-batch takes, one file at least
#: (nothing is dropped, the next batch goes on).
BYTES_PER_TRIGGER = 1 << 30


def _trigger(w: DataStreamWriter, live: bool, batch_interval: str) -> DataStreamWriter:
    return w.trigger(processingTime=batch_interval) if live else w.trigger(availableNow=True)


def packet_source(
    spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = BYTES_PER_TRIGGER,
) -> DataFrame:
    """Stream of packet lines.  A number of files a trigger goes before the bytes
    (Spark's file source takes one of the two limits)."""
    reader = spark.readStream.schema(LINE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    return reader.text(input_dir)


def decoded_frames(lines: DataFrame, keep=()) -> DataFrame:
    """Same transformation as the batch path: parse, then decode."""
    return decode_packets(parse_packets(lines, keep=keep))


def start_packet_stream(
    spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str,
    live: bool = False, batch_interval: str = BATCH_INTERVAL, max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = BYTES_PER_TRIGGER, follow: bool = False,
) -> StreamingQuery:
    """Packet files -> decoded frames appended to parquet in ``output_dir``.

    Per micro-batch counters (lines received, ``END`` markers, frames
    decoded) are attached with ``observe`` and appear in the query progress
    under ``observedMetrics``.  ``follow`` also reads lines that are appended to
    files already seen."""
    source = (growing_lines(spark, input_dir).select("value") if follow
              else packet_source(spark, input_dir, max_files_per_trigger, max_bytes_per_trigger))
    lines = source.observe(
        "packet_lines",
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("value") == F.lit(END_MARKER)).alias("end_markers"),
    )
    frames = decoded_frames(lines).observe("decoded_frames", F.count(F.lit(1)).alias("frames"))
    writer = (
        frames.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    return _trigger(writer, live, batch_interval).start()


def start_frame_file_stream(
    spark: SparkSession, input_dir: str, frames_dir: str, checkpoint_dir: str,
    live: bool = False, batch_interval: str = BATCH_INTERVAL, max_files_per_trigger: int | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None, max_bytes_per_trigger: int | None = BYTES_PER_TRIGGER,
) -> StreamingQuery:
    """Packet files -> one file per frame id in ``frames_dir``; a frame id
    seen again later replaces its file (last arrival wins).  ``transform``
    changes the frames (frame_id, data) on their way.  An ``END`` marker ends its
    file: lines behind it go, other files are not touched.

    Within a batch the last line per id wins (order: file modification time,
    file, split offset, position in split); across batches the later batch
    rewrites the file.  Rewriting is idempotent, so a replayed batch after a
    failure leaves the same files."""
    register_frame_files(spark)
    lines = packet_source(spark, input_dir, max_files_per_trigger, max_bytes_per_trigger).select(
        "value",
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ordered = batch.withColumn(
            "arrival", F.struct("mtime", "file", "block", F.monotonically_increasing_id().alias("pos"))
        )
        numbered = arrival_number(until_end(ordered.select("value", "arrival")))
        frames = decoded_frames(numbered, keep=["arrival_number"])
        latest = latest_per_id(frames, "frame_id", "arrival_number", ["data"], unique_order=True)
        if transform is not None:
            latest = transform(latest.select("frame_id", "data"))
        write_frame_files(
            latest.select(frame_file_name("frame_id").alias("file_name"), F.col("data").alias("content")),
            frames_dir,
            mode="append",
        )

    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    return _trigger(writer, live, batch_interval).start()

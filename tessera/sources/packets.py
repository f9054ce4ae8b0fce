"""Packet and JSON-lines files.

Packets travel as text files of ``<frame_id>|<base64>`` lines (the socket
of the original design becomes a folder that producers drop files into);
the batch reader and the streaming reader (``tessera.streaming``) read the
same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.text import write_lines

LINE_SCHEMA = "value string"


def write_packet_lines(lines: DataFrame, path: str) -> None:
    """Write ``lines(value)`` as text files in ``path``."""
    write_lines(lines, path, "value")


def read_packet_lines(spark: SparkSession, path: str, with_arrival: bool = False) -> DataFrame:
    """Packet lines of every file in ``path``.

    ``with_arrival`` adds an ``arrival`` struct that orders lines the way
    they arrived: file modification time, file name, offset of the file
    split, then position within the split."""
    df = spark.read.schema(LINE_SCHEMA).text(path)
    if not with_arrival:
        return df
    return df.select(
        "value",
        F.struct(
            F.col("_metadata.file_modification_time").alias("mtime"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("arrival"),
    )


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per line (``to_json`` of all columns)."""
    write_lines(df.select(F.to_json(F.struct(*df.columns)).alias("value")), path, "value")


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)

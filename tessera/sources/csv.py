"""Delimited files with a header, quoted fields that may span lines and a
doubled quote as escape (``;`` by default).

Reading with an explicit schema avoids the extra inference pass over the
data; ``infer=True`` keeps the inferring behaviour available.  Spark's own
reader takes a multi-line file as one task, so the writer bounds the records per
file; ``sources/csv_ranges.py`` reads files of any size in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

RECORDS_PER_FILE = 50_000
# Reader-side null marker used when empty strings must survive: an unquoted
# empty field then still reads as NULL, a quoted empty field as ''.
NULL_SENTINEL = "\u0000"


def _options(sep: str) -> dict[str, str]:
    return {
        "sep": sep,
        "header": "true",
        "quote": '"',
        "escape": '"',
    }


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ";",
    multi_line: bool = True,
    infer: bool = False,
    keep_empty_strings: bool = False,
) -> DataFrame:
    """Read delimited files.

    By default an empty field, quoted or not, reads as NULL (Spark's and the
    original scripts' behaviour).  ``keep_empty_strings`` reads a quoted
    empty field (what ``write_csv`` writes for ``''``) as ``''``."""
    reader = spark.read.options(**_options(sep)).option("multiLine", str(multi_line).lower())
    if keep_empty_strings:
        reader = reader.option("nullValue", NULL_SENTINEL)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ";", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write with the reader's dialect; text is kept byte for byte (no
    whitespace trimming, quotes doubled, line breaks inside quotes)."""
    (
        df.write.mode("overwrite")
        .options(**_options(sep))
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("maxRecordsPerFile", str(records_per_file))
        .csv(path)
    )


def land_csv_as_parquet(
    spark: SparkSession,
    csv_path: str,
    parquet_path: str,
    schema: StructType | str,
    sep: str = ";",
    keep_empty_strings: bool = False,
) -> DataFrame:
    """Read multi-line CSV once, with several tasks per file, and keep it as
    parquet, which later queries read with column pruning and pushed filters.
    Returns the parquet-backed frame."""
    from tessera.sources.csv_ranges import read_csv_ranges

    read_csv_ranges(spark, csv_path, schema, sep=sep, keep_empty_strings=keep_empty_strings).write.mode(
        "overwrite"
    ).parquet(parquet_path)
    return spark.read.schema(schema).parquet(parquet_path)

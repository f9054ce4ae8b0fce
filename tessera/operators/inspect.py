"""Schema and sample inspection in testable (DataFrame) form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

SCHEMA_ROW_TYPE = "table string, pos int, column string, type string, nullable boolean"


def schema_rows(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """One row per column of each frame: what ``printSchema`` prints.
    Built from driver-side metadata only (no data is read)."""
    rows = [
        (table, pos, f.name, f.dataType.simpleString(), f.nullable)
        for table, df in frames.items()
        for pos, f in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(rows, SCHEMA_ROW_TYPE)


def sample_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows by a key (``show(n)`` made deterministic)."""
    return df.orderBy(*order).limit(n)

"""Facts landed once, bucketed by their join key, so that later joins on it do
not exchange them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tessera.session import scratch_dir

#: Bytes (as Spark's statistics give them) that a bucket should hold.
BUCKET_BYTES = 256 << 20


def bucket_count(bytes_of_largest: int, at_least: int) -> int:
    """Buckets for the largest of the tables that are joined: the same number for
    all of them, a power of two, so tables landed later can be a multiple."""
    wanted, n = max(at_least, -(-bytes_of_largest // BUCKET_BYTES)), 1
    while n < wanted:
        n *= 2
    return n


def land_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``keys`` and return the
    table, whose scans keep the bucketing.  The rows are dealt by the same hash
    first, so every bucket is one file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
     .option("path", path or scratch_dir(spark, name)).saveAsTable(table))
    return spark.table(table)

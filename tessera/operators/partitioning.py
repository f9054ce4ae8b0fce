"""Partition layout and reuse: partitions of a given row count, and computing a
shared intermediate once."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sized_partitions(df: DataFrame, rows_per_partition: int) -> DataFrame:
    """``max(1, n // rows_per_partition)`` partitions for ``n`` rows (one
    counting job first) -- for very heavy per-row work such as model inference
    on frames.  Scans size their own splits (``spark.sql.files.*``); nothing
    else repartitions."""
    return df.repartition(max(1, df.count() // rows_per_partition))


def input_bytes(df: DataFrame) -> int:
    """Bytes of all files that ``df`` scans, by Spark's statistics (no job);
    sources of unknown size count as nothing."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves().iterator()
    total = 0
    while leaves.hasNext():
        size = int(str(leaves.next().stats().sizeInBytes()))
        total += size if size < 1 << 60 else 0
    return total


def materialize(df: DataFrame) -> DataFrame:
    """Compute a (small) intermediate result once and cut its lineage, for a
    plan that reads it more than once (e.g. a grand total and a top-N of the
    same grouped result).  One job writes it below the shared
    ``spark.checkpoint.dir``, where a lost executor cannot lose it; it goes with
    the other scratch folders when the process ends."""
    from tessera.session import scratch_dir

    path = scratch_dir(df.sparkSession, "materialized")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Sharding (operator 13): rendezvous hashing over weighted shards.

A record's stable key and every shard give one uniform draw u in (0, 1); the
record belongs to the shard with the least ``-ln(u) / weight``.  Draws do not
depend on the number of shards, so a shard that is added takes records only
into itself (its share of all weight), and one that is removed hands out only
its own.

``write_shards`` lands the records as Parquet, one folder per shard; Spark
rebalances by shard, so a shard is as many files as its size asks for.
``number_rows`` gives every record its place in its shard, gapless from 0, in
order of the given columns: rows are range-partitioned by shard and those
columns, each stretch counts itself, and two levels of prefix sums over the
counts (``FAN`` stretches each) add up what lies before.

Defined results: a null key is replaced by the text's digest (such rows spread
by text, equal texts stay together); null text counts as empty; rows with equal
keys share a shard; an empty table gives an empty result; columns named like
the new ones are left out of the result of ``shard_digest`` and kept, under
their own names, in the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import land
from tessera.session import scratch_dir

#: Stretches whose counts are summed by one window of ``number_rows``.
FAN = 1024
_DIGITS = 13  # hex digits of a draw: 52 bits, exact in a double


def record_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id as text, or the text's digest where the id is null."""
    return F.coalesce(F.col(id_col).cast("string"),
                      F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text_col), F.lit("")))))


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Number of the shard that wins ``key``; ties go to the smaller number."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")

    def cost(weight: Column, shard: Column) -> Column:
        digest = F.md5(F.concat_ws(":", key, shard.cast("string")))
        draw = (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + 0.5) / float(16**_DIGITS)
        return F.struct((-F.log(draw) / weight).alias("cost"), shard.alias("shard"))

    return F.array_min(F.transform(F.array(*[F.lit(float(w)) for w in weights]), cost))["shard"].cast("int")


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with as many underscores behind it as make it new."""
    while wanted.lower() in {c.lower() for c in columns}:
        wanted += "_"
    return wanted


def write_shards(docs: DataFrame, folder: str, weights: list[float], id_col: str = "doc_id",
                 text_col: str = "text") -> str:
    """Write all columns of ``docs`` below ``folder``, one ``shard=<n>`` folder
    each; returns the name of the folder column."""
    shard = free_name(docs.columns, "shard")
    placed = docs.withColumn(shard, rendezvous(record_key(id_col, text_col), weights))
    placed.hint("rebalance", F.col(shard)).write.partitionBy(shard).option("compression", "zstd").parquet(folder)
    return shard


def read_shards(spark: SparkSession, folder: str, schema, shard: str = "shard") -> DataFrame:
    """The records of all shards with the number of their shard."""
    return spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, "
                             f"`{shard}` int").parquet(folder)


def number_rows(rows: DataFrame, group: str, order: list[str], slot: str = "slot", fan: int = FAN) -> DataFrame:
    """``rows`` with their place in their group, gapless from 0, in order of
    ``order``; rows equal in it follow each other in any order."""
    columns = rows.columns
    keyed = rows.withColumn("__at", F.monotonically_increasing_id())  # splits runs of equal rows
    sort = [group, *order, "__at"]
    placed = keyed.repartitionByRange(*sort).sortWithinPartitions(*sort).drop("__at")
    placed = land(placed.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("__part", F.shiftrightunsigned("__row", 33))
    parts = placed.groupBy(group, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    parts = parts.withColumn("__upper", F.floor(F.col("__part") / fan))

    def before(*keys, by):
        return Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    uppers = parts.groupBy(group, "__upper").agg(F.sum("__n").alias("__sum")).select(
        F.col(group).alias("__g"), F.col("__upper").alias("__u"),
        F.coalesce(F.sum("__sum").over(before(group, by="__upper")), F.lit(0)).alias("__base"))
    starts = parts.withColumn("__in", F.coalesce(F.sum("__n").over(before(group, "__upper", by="__part")), F.lit(0)))
    starts = starts.join(uppers, (F.col(group) == F.col("__g")) & (F.col("__upper") == F.col("__u"))).select(
        F.col(group).alias("__g"), F.col("__part").alias("__p"),
        (F.col("__base") + F.col("__in") - F.col("__first")).alias("__shift"))
    return placed.join(starts, (F.col(group) == F.col("__g")) & (F.col("__part") == F.col("__p"))).select(
        *columns, (F.col("__row") + F.col("__shift")).alias(slot))


def shard_digest(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                 folder: str | None = None) -> DataFrame:
    """Shards of equal weight, written below ``folder`` and read back: per
    record ``doc_id, size`` (bytes of the text and one), ``text_crc32, law, shard,
    slot`` (place in the shard) and ``grown_shard`` (the shard with one more)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    folder = folder or scratch_dir(spark, "shards")
    write_shards(rows, folder, [1.0] * shards)
    text = F.coalesce("text", F.lit(""))
    digest = read_shards(spark, folder, rows.schema).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", rendezvous(record_key(), [1.0] * (shards + 1)).alias("grown_shard"))
    return number_rows(digest, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

"""Text-line and headerless delimited sources (and the matching writers).

A delimited record is split positionally on a literal delimiter with no
quoting and no trimming, like ``line.split(',')``.  In strict mode a short
line or a bad number fails the job; in tolerant
mode they become NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.casts import strict_cast, strict_field, tolerant_cast, tolerant_field
from tessera.functions.scalars import split_literal


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``DataFrame(value string)``, one row per line.  Several paths are one
    scan (bag union of their lines, duplicates kept)."""
    if isinstance(paths, str):
        paths = [paths]
    return spark.read.text(list(paths))


def parse_delimited(
    lines: DataFrame,
    fields: Mapping[int, str],
    types: Mapping[str, str] | None = None,
    delimiter: str = ",",
    strict: bool = True,
    value_col: str = "value",
) -> DataFrame:
    """Pick fields by position from each line.

    ``fields`` maps position -> output name; ``types`` maps output name ->
    Spark type for fields that are converted (others stay strings)."""
    types = dict(types or {})
    parts = split_literal(value_col, delimiter)
    pick = strict_field if strict else tolerant_field
    conv = strict_cast if strict else tolerant_cast
    cols: list[Column] = []
    for pos, name in fields.items():
        c = pick(parts, pos)
        if name in types:
            c = conv(c, types[name])
        cols.append(c.alias(name))
    return lines.select(*cols)


def to_delimited_line(cols: Sequence[Column | str], delimiter: str = ",") -> Column:
    """Join columns into one text line; a NULL field is empty and keeps its place."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    return F.concat_ws(delimiter, *parts)


def write_lines(df: DataFrame, path: str, value: Column | str = "value", partition_by: str | None = None) -> None:
    """Write one text line per row (``df`` keeps its partitioning: one file
    per task)."""
    line = (F.col(value) if isinstance(value, str) else value).alias("value")
    keep = [F.col(partition_by)] if partition_by else []
    w = df.select(*keep, line).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.text(path)


def read_delimited_quoted(
    spark: SparkSession, paths: str | Sequence[str], schema: str, delimiter: str = ",",
) -> DataFrame:
    """Headerless delimited files where a field may be quoted
    (``7,"Good, The",Drama``), so a delimiter inside quotes does not shift
    the columns.  Fields are converted by ``schema``; a value that does not
    convert becomes NULL (the CSV reader's permissive mode)."""
    if isinstance(paths, str):
        paths = [paths]
    return (
        spark.read.schema(schema)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("header", "false")
        .csv(list(paths))
    )

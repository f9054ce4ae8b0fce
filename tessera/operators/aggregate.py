"""Aggregate building blocks.

All grouped aggregates here are decomposable (sum, count, max_by), so Spark
plans them as partial aggregation before the shuffle and final aggregation
after it: a key holding a third of all rows is collapsed map-side and never
lands as raw rows in one task.

Sums are plain double sums by default, like the averages they feed.  Where the
caller knows a column's scale, ``exact_sum`` (or ``scale=`` of the average
builders) accumulates decimals instead: the same result for any partitioning,
executor count or retry order.  A value that does not fit the scale, NaN and
infinity included, fails the job, and so does a sum that overflows -- with ANSI
mode on or off.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import ColumnOrName, _col


def as_decimal(c: ColumnOrName, scale: int) -> Column:
    """The value as ``decimal(18, scale)``; a value with more decimals, or too
    large, fails the job."""
    v = _col(c)
    exact = v.try_cast(f"decimal(18,{scale})")
    fits = exact.isNotNull() & (exact.cast("double") == v.cast("double"))
    message = F.concat(F.lit(f"value does not fit scale {scale}: "), v.cast("string"))
    return F.when(v.isNull() | fits, exact).otherwise(F.raise_error(message))


def checked_sum(c: ColumnOrName) -> Column:
    """Sum of decimals; an overflow fails the job also where ANSI mode is off."""
    v = _col(c)
    return F.when(F.sum(v).isNull() & (F.count(v) > 0), F.raise_error(F.lit("decimal sum overflows"))
                  ).otherwise(F.sum(v))


def exact_sum(c: ColumnOrName, scale: int) -> Column:
    """Order-independent sum of values with at most ``scale`` decimals."""
    return checked_sum(as_decimal(c, scale))


def _sum(c: Column, scale: int | None) -> Column:
    return F.sum(c.cast("double")) if scale is None else exact_sum(c, scale)


def mean_of(total: ColumnOrName, count: ColumnOrName) -> Column:
    """Average from a sum and a count; NULL (not an error) for a zero count."""
    return F.try_divide(_col(total).cast("double"), _col(count).cast("double"))


def partial_sums(
    df: DataFrame, keys: Sequence[str], value: ColumnOrName, sum_name: str = "value_sum",
    count_name: str = "value_count", scale: int | None = None,
) -> DataFrame:
    """(keys, sum, non-null count) -- the combinable ``(sum, count)`` pair of an
    average, for re-aggregation at a coarser key later."""
    v = _col(value)
    return df.groupBy(*keys).agg(_sum(v, scale).alias(sum_name), F.count(v).alias(count_name))


def combine_sums(
    df: DataFrame, keys: Sequence[str], sum_name: str = "value_sum", count_name: str = "value_count",
) -> DataFrame:
    """Re-aggregate ``partial_sums`` output at the coarser ``keys``."""
    return df.groupBy(*keys).agg(
        F.sum(sum_name).alias(sum_name), F.sum(count_name).alias(count_name)
    )


def finish_average(
    df: DataFrame, avg_name: str, count_name_out: str,
    sum_name: str = "value_sum", count_name: str = "value_count",
) -> DataFrame:
    """Turn (sum, count) columns into (average, count)."""
    others = [c for c in df.columns if c not in (sum_name, count_name)]
    return df.select(
        *others,
        mean_of(sum_name, count_name).alias(avg_name),
        F.col(count_name).cast("bigint").alias(count_name_out),
    )


def average_by(
    df: DataFrame, keys: Sequence[str], value: ColumnOrName,
    avg_name: str = "avg_value", count_name: str = "value_count", scale: int | None = None,
) -> DataFrame:
    """Average and count of ``value`` per key (one shuffle, map-side combine)."""
    return finish_average(partial_sums(df, keys, value, scale=scale), avg_name, count_name)


def pivot_average(
    df: DataFrame, keys: Sequence[str], label_col: str, labels: Mapping[str, str],
    value: ColumnOrName, scale: int | None = None,
) -> DataFrame:
    """Average of ``value`` per key for each fixed label, one column per label.

    A label with no rows for a key gives NULL; labels outside ``labels`` are
    ignored but their keys still get a row.  Written as conditional
    aggregates, so it is one aggregation with one shuffle (a ``pivot`` with
    fixed values plans two)."""
    v = _col(value)
    aggs = []
    for label, out_name in labels.items():
        picked = F.when(F.col(label_col) == F.lit(label), v)
        aggs.append(mean_of(_sum(picked, scale), F.count(picked)).alias(out_name))
    return df.groupBy(*keys).agg(*aggs)


def count_by(df: DataFrame, keys: Sequence[ColumnOrName], counted: ColumnOrName, name: str) -> DataFrame:
    """``count(counted)`` per key (NULL values of ``counted`` not counted)."""
    return df.groupBy(*keys).agg(F.count(_col(counted)).alias(name))


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """One-row frame with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, c: ColumnOrName, name: str = "distinct_count") -> DataFrame:
    """``select(c).distinct().count()``: a NULL value counts as one value."""
    return row_count(df.select(_col(c).alias("_v")).distinct(), name)


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows by ``order`` (planned as TakeOrderedAndProject: each
    task keeps its own top ``n``, no full sort)."""
    return df.orderBy(*order).limit(n)


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position by ``order``.  Only for small, bounded frames (a
    top-N result): an un-partitioned window runs in a single task."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def best_with_support(
    df: DataFrame, count_col: str, min_support: int, order: Sequence[Column],
) -> DataFrame:
    """Top-1 row by ``order`` among rows with ``count_col >= min_support``;
    empty when no row qualifies."""
    return top_n(df.filter(F.col(count_col) >= min_support), 1, order)


def quality_split(df: DataFrame, valid: Column) -> DataFrame:
    """One pass: total, valid and invalid row counts."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(valid).alias("valid_rows")
    ).select(
        "total_rows", "valid_rows", (F.col("total_rows") - F.col("valid_rows")).alias("invalid_rows")
    )


def conditional_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """One pass, one row: ``count_if`` for each named predicate."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])

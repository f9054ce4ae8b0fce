"""Joins.  The reference only has inner equi-joins.

Strategy: no blanket broadcast hints.  The planner broadcasts a side only
when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``,
and AQE re-checks with the measured shuffle size at runtime; anything larger
runs as a shuffled sort-merge join whose skewed partitions AQE splits
(``spark.sql.adaptive.skewJoin.enabled``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner ``USING`` join: the key is kept once, unmatched rows on either
    side vanish, a duplicated dimension key fans out, NULL keys never match."""
    return fact.join(dim, on=on, how="inner")


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name (duplicates kept)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

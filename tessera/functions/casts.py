"""Fail-fast and tolerant casts.

The strict forms stop the job on one bad record, like Python's ``float(x)`` /
``int(x)``, with ANSI mode on or off.  ``try_cast`` turns bad text into NULL so
the row can be routed to the invalid side of a quality split.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.scalars import ColumnOrName, _col


def strict_cast(c: ColumnOrName, to: str) -> Column:
    """Cast that fails the job on a value that does not convert."""
    v = _col(c)
    message = F.concat(F.lit(f"not a valid {to}: "), v.cast("string"))
    return F.when(v.isNull() | v.try_cast(to).isNotNull(), v.try_cast(to)).otherwise(F.raise_error(message).cast(to))


def tolerant_cast(c: ColumnOrName, to: str) -> Column:
    """Cast that yields NULL on a value that does not convert."""
    return _col(c).try_cast(to)


def strict_field(arr: ColumnOrName, index: int) -> Column:
    """``fields[index]`` of a split line; a short line fails the job."""
    a = _col(arr)
    message = F.concat(F.lit(f"no field {index} in a line of "), F.size(a).cast("string"))
    return F.when(a.isNull() | (F.size(a) > index), F.get(a, index)).otherwise(F.raise_error(message).cast("string"))


def tolerant_field(arr: ColumnOrName, index: int) -> Column:
    """``fields[index]`` of a split line; a short line gives NULL."""
    return F.get(_col(arr), index)


def in_closed_range(c: ColumnOrName, low, high) -> Column:
    """Not NULL and ``low <= c <= high``."""
    c = _col(c)
    return c.isNotNull() & (c >= low) & (c <= high)

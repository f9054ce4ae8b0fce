"""tessera: star-schema aggregates, dirty-data handling and frame-packet
processing written as plain PySpark DataFrame / Structured Streaming jobs.

Sub-packages:

* ``sources``    readers for parquet tables, delimited text, CSV, packet files,
                 JSON lines, and a per-frame binary file sink.
* ``functions``  column expressions (casts, formatting, base64, age buckets...).
* ``operators``  DataFrame -> DataFrame building blocks (averages, pivots,
                 shares, top-N, quality split, frame transforms).
* ``plans``      the named queries, each paired with an equivalent SQL text.
* ``streaming``  the packet pipeline as a Structured Streaming query.
"""

from tessera.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

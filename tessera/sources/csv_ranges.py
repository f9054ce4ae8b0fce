"""Delimited files with line breaks inside quotes, read in parallel.

A line break is a record's end only outside quotes, which a reader that starts
in the middle of a file cannot tell.  So the files are cut into byte ranges and
read twice:

1. Every range reports, for each state it may begin in (outside quotes, inside,
   just behind a closing quote), the state it ends in.  That is one small row a
   range; following them from the start of each file gives the state in which
   every range really begins.
2. A Python data source with one partition per range cuts the records that begin
   in its range, reading on behind its end for the last one.  The records' text
   goes to Spark's own ``from_csv``, so fields, types and nulls are those of the
   built-in reader.

A quote opens a field only at the field's start (behind a separator or a line
break); elsewhere outside quotes it is data, as for the built-in reader.  Line
breaks are LF or CR LF, as the file's first line has them; CR LF inside quotes
reads as LF, like there.  Empty lines are skipped.  Paths go through
``pyarrow.fs``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

FORMAT_NAME = "quoted_records"
#: Largest and smallest byte range of one task.
RANGE_BYTES = 128 << 20
LEAST_RANGE_BYTES = 256 << 10
CHUNK = 8 << 20
OUTSIDE, INSIDE, CLOSED = 0, 1, 2
_QUOTE, _LF, _CR = 0x22, 0x0A, 0x0D
_BATCH = 4096


def _open(path: str):
    # kept here on purpose: this module travels to executors by value
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme):]
    filesystem, name = fs.FileSystem.from_uri(path)
    return filesystem, name


def toggles(data: bytes, before: int, state: int, sep: int):
    """Positions of the quotes that open or close a field in ``data``, and the
    state behind it.  ``before`` is the byte in front (-1: start of the file),
    ``state`` the state there."""
    import numpy as np

    values = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(values == _QUOTE)
    if not len(at):
        return at, INSIDE if state == INSIDE else OUTSIDE
    ahead = values[at - 1].astype(np.int64)
    if at[0] == 0:
        ahead[0] = before
    begins = (ahead == sep) | (ahead == _LF) | (ahead == _CR) | (ahead == -1)
    opens = np.arange(len(at)) % 2 == (state == INSIDE)
    fine = begins | (ahead == _QUOTE)
    if at[0] == 0 and state != CLOSED:
        fine[0] = begins[0]
    if fine[opens].all():  # every quote opens or closes
        inside = (len(at) + (state == INSIDE)) % 2
        return at, INSIDE if inside else CLOSED if at[-1] == len(data) - 1 else OUTSIDE
    out, closed, inside = [], 0 if state == CLOSED else -1, state == INSIDE
    for p, field in zip(at.tolist(), begins.tolist()):
        if inside:
            inside, closed = False, p + 1
        elif field or p == closed:
            inside = True
        else:
            continue  # a quote amid an unquoted field
        out.append(p)
    return np.array(out, np.int64), INSIDE if inside else CLOSED if closed == len(data) else OUTSIDE


def range_states(filesystem, name: str, start: int, end: int, sep: int) -> list[int]:
    """State behind ``[start, end)`` for each of the three states before it."""
    states = [OUTSIDE, INSIDE, CLOSED]
    with filesystem.open_input_file(name) as f:
        before = f.read_at(1, start - 1)[0] if start else -1
        while start < end:
            data = f.read_at(min(CHUNK, end - start), start)
            states = [toggles(data, before, s, sep)[1] for s in states]
            before, start = data[-1], start + len(data)
    return states


def records(filesystem, name: str, start: int, end: int, state: int, sep: int, chunk: int = CHUNK) -> Iterator[bytes]:
    """The records that begin in ``[start, end)``, without their line break.
    ``state`` is the state before ``start``."""
    import numpy as np

    with filesystem.open_input_file(name) as f:
        size = f.size()
        before = f.read_at(1, start - 1)[0] if start else -1
        # a record begins here, or behind the next line break outside quotes
        open_record = start == 0 or (state != INSIDE and before == _LF)
        held: list[bytes] = []
        at = start
        while at < size and (at < end or open_record):
            data = f.read_at(min(chunk, size - at), at)
            turn, after = toggles(data, before, state, sep)
            breaks = np.flatnonzero(np.frombuffer(data, np.uint8) == _LF)
            inside = (np.searchsorted(turn, breaks) + (state == INSIDE)) % 2
            first = 0
            for p in breaks[inside == 0].tolist():
                if open_record:
                    held.append(data[first:p])
                    yield held[0] if len(held) == 1 else b"".join(held)
                    held = []
                first, open_record = p + 1, at + p + 1 < end
                if not open_record and at + p + 1 >= end:
                    return
            if open_record:
                held.append(data[first:])
            before, state, at = data[-1], after, at + len(data)
        if open_record and held and any(held):
            yield b"".join(held)


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, state: int):
        self.path, self.start, self.end, self.state = path, start, end, state


class QuotedRecordsReader(DataSourceReader):
    def __init__(self, options):
        self.sep, self.size, self.header = ord(options["sep"]), int(options["rangeBytes"]), options["header"] == "true"
        self.files = json.loads(options["files"])  # [path, bytes, state before each range as digits]

    def partitions(self):
        return [Range(path, i * self.size, min((i + 1) * self.size, total), int(state))
                for path, total, states in self.files for i, state in enumerate(states)]

    def read(self, partition):
        import pyarrow as pa

        filesystem, name = _open(partition.path)
        with filesystem.open_input_file(name) as f:
            windows, at = False, 0
            while at < f.size():
                data = f.read_at(1 << 16, at)
                found = data.find(b"\n")
                if found >= 0:
                    windows = data[found - 1: found] == b"\r" if found else at > 0 and f.read_at(1, at - 1) == b"\r"
                    break
                at += len(data)
        out, held = [], 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["record"])

        skip = self.header and partition.start == 0
        for record in records(filesystem, name, partition.start, partition.end, partition.state, self.sep):
            if windows:
                record = record.removesuffix(b"\r").replace(b"\r\n", b"\n")
            if not record:
                continue
            if skip:
                skip = False
                continue
            out.append(record.decode("utf-8", "replace"))
            held += len(record)
            if len(out) >= _BATCH or held > CHUNK:
                yield batch()
                out, held = [], 0
        if out:
            yield batch()


class QuotedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> QuotedRecordsReader:
        # option names arrive in lower case
        options = {"rangeBytes" if k.lower() == "rangebytes" else k.lower(): v for k, v in self.options.items()}
        return QuotedRecordsReader(options)


def _by_value() -> None:
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files at ``path``, a file or a folder."""
    from pyarrow import fs

    filesystem, root = _open(path)
    info = filesystem.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else filesystem.get_file_info(fs.FileSelector(root, recursive=True))
    prefix = path[: len(path.rstrip("/")) - len(root.rstrip("/"))] if path.rstrip("/").endswith(root.rstrip("/")) else ""
    return sorted((prefix + f.path, f.size) for f in found
                  if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", ".")))


def range_size(spark: SparkSession, total: int) -> int:
    """Like Spark's own splits: small enough for all cores, at most RANGE_BYTES."""
    return max(LEAST_RANGE_BYTES, min(RANGE_BYTES, -(-total // max(spark.sparkContext.defaultParallelism, 1))))


def file_states(spark: SparkSession, files: list[tuple[str, int]], size: int, sep: str) -> list[tuple[str, int, str]]:
    """(path, bytes, state before each range): ranges are looked at in parallel,
    one short row each comes back."""
    _by_value()
    ranges = [(i, k, path, k * size, min((k + 1) * size, total))
              for i, (path, total) in enumerate(files) for k in range(-(-total // size))]
    code = ord(sep)

    def look(batches):
        import pandas as pd

        for pdf in batches:
            states = [range_states(*_open(r.path), r.start, r.end, code) for r in pdf.itertuples()]
            yield pd.DataFrame({"file": pdf["file"], "place": pdf["place"],
                                "ends": ["".join(map(str, s)) for s in states]})

    rows = spark.createDataFrame(ranges, "file int, place int, path string, start long, end long").repartition(
        max(1, min(len(ranges), 16 * spark.sparkContext.defaultParallelism)), "file", "place")
    ends = {(r["file"], r["place"]): r["ends"]
            for r in rows.mapInPandas(look, "file int, place int, ends string").collect()}
    out = []
    for i, (path, total) in enumerate(files):
        states, now = [], OUTSIDE
        for k in range(-(-total // size)):
            states.append(str(now))
            now = int(ends[i, k][now])
        out.append((path, total, "".join(states)))
    return out


def read_records(spark: SparkSession, path: str, sep: str = ";", header: bool = True,
                 range_bytes: int | None = None) -> DataFrame:
    """One row per record: its text, line breaks inside quotes included."""
    if len(sep.encode()) != 1 or sep in '"\n\r':
        raise ValueError("the separator must be one byte, and neither quote nor line break")
    files = list_files(path)
    size = range_bytes or range_size(spark, sum(n for _, n in files))
    if not files:
        return spark.createDataFrame([], "record string")
    _by_value()
    spark.dataSource.register(QuotedRecords)
    return (spark.read.format(FORMAT_NAME).option("sep", sep).option("header", str(header).lower())
            .option("rangeBytes", size).option("files", json.dumps(file_states(spark, files, size, sep))).load())


def header_names(path: str, sep: str = ";") -> list[str]:
    """Field names of the first file's first record."""
    import csv

    for name, _ in list_files(path):
        filesystem, root = _open(name)
        size = filesystem.get_file_info(root).size
        for record in records(filesystem, root, 0, size, OUTSIDE, ord(sep), 1 << 16):
            text = record.decode("utf-8", "replace").removesuffix("\r")
            if text:
                return next(csv.reader([text], delimiter=sep))
    return []


def read_csv_ranges(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ";",
                    keep_empty_strings: bool = False, range_bytes: int | None = None) -> DataFrame:
    """``read_csv`` for multi-line files, with several tasks per file.  Without a
    schema all fields are text, named by the header."""
    from tessera.sources.csv import NULL_SENTINEL

    if schema is None:
        schema = StructType([StructField(n, StringType()) for n in header_names(path, sep)])
    options = {"sep": sep, "quote": '"', "escape": '"'}
    if keep_empty_strings:
        options["nullValue"] = NULL_SENTINEL
    if not isinstance(schema, StructType):
        schema = StructType.fromDDL(schema)
    rows = read_records(spark, path, sep, range_bytes=range_bytes)
    parsed = F.from_csv("record", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), options)
    return rows.select(parsed.alias("row")).select("row.*")

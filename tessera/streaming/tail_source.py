"""Packet files that grow: a streaming source that reads appended lines.

Spark's file source takes a file once; lines appended later are never seen.
This Python data source keeps, per file, the byte up to which lines have been
read.  Every batch takes what was appended up to the last line break; a last
line without one is held back until it is whole.  Offsets are in the query's
checkpoint and the bytes behind them do not change, so a restarted or repeated
batch reads the same lines: none is lost or read twice.

A batch is cut into ranges of at most ``RANGE_BYTES``; a line belongs to the range
in which it begins.  The offset has one entry per file of the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT_NAME = "growing_lines"
SCHEMA = "value string, file string, position long"
RANGE_BYTES = 64 << 20
CHUNK = 1 << 20
_BATCH = 4096


def _open(path: str):
    # kept here on purpose: this module travels to executors by value
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    for scheme in ("s3a://", "s3n://"):
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme):]
    return fs.FileSystem.from_uri(path)


def whole_lines_end(filesystem, name: str, start: int, size: int) -> int:
    """The byte behind the last line break in ``[start, size)``, or ``start``."""
    with filesystem.open_input_file(name) as f:
        end = size
        while end > start:
            begin = max(start, end - CHUNK)
            found = f.read_at(end - begin, begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            end = begin
    return start


def lines_of(filesystem, name: str, start: int, end: int, first: bool):
    """(line, position) of the lines that begin in ``[start, end)``; ``first`` says
    that one begins at ``start``.  Their line breaks are all in the file."""
    with filesystem.open_input_file(name) as f:
        size = f.size()
        if not first:  # behind the break of the line that the range before has begun
            at, start = start - 1, -1
            while at < size and start < 0:
                data = f.read_at(min(CHUNK, size - at), at)
                found = data.find(b"\n")
                start = at + found + 1 if found >= 0 else -1
                at += len(data)
            if start < 0:
                return
        held, at, begun = b"", start, start
        while begun < end and at < size:
            data = f.read_at(min(CHUNK, size - at), at)
            at += len(data)
            *lines, held = (held + data).split(b"\n")
            for line in lines:
                if begun >= end:
                    return
                yield line.removesuffix(b"\r"), begun
                begun += len(line) + 1


class LineRange(InputPartition):
    def __init__(self, file: str, start: int, end: int, first: bool):
        self.file, self.start, self.end, self.first = file, start, end, first


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        filesystem, root = _open(self.path)
        out = {}
        for info in filesystem.get_file_info(fs.FileSelector(root, allow_not_found=True)):
            if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
                out[info.base_name] = whole_lines_end(filesystem, info.path, 0, info.size)
        return out

    def partitions(self, start: dict, end: dict):
        out = []
        for file, to in sorted(end.items()):
            begin = start.get(file, 0)
            for a in range(begin, to, self.range_bytes):
                out.append(LineRange(file, a, min(a + self.range_bytes, to), a == begin))
        return out

    def read(self, partition):
        import pyarrow as pa

        filesystem, root = _open(self.path)
        rows = lines_of(filesystem, f"{root.rstrip('/')}/{partition.file}", partition.start, partition.end, partition.first)
        lines, places, held = [], [], 0

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array(lines, pa.string()), pa.array([partition.file] * len(lines), pa.string()), pa.array(places, pa.int64())],
                names=["value", "file", "position"])

        for line, position in rows:
            lines.append(line.decode("utf-8", "replace"))
            places.append(position)
            held += len(line)
            if len(lines) >= _BATCH or held > CHUNK:
                yield batch()
                lines, places, held = [], [], 0
        if lines:
            yield batch()


class GrowingLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> GrowingLinesReader:
        path = self.options.get("path")
        if not path:
            raise ValueError("growing_lines needs a path")
        return GrowingLinesReader(path, int(self.options.get("rangeBytes", RANGE_BYTES)))


def growing_lines(spark: SparkSession, input_dir: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Stream of (value, file, position): every whole line of the folder's files,
    those that are appended while the query runs included."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT_NAME).option("rangeBytes", range_bytes).load(input_dir)

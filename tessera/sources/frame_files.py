"""One file per frame, written by the executors and published as a whole.

Spark has no built-in writer that turns each row into its own file, so this
is a small Python Data Source (``pyspark.sql.datasource``):

    df.select(file_name, content).write.format("frame_files")
      .mode("overwrite").save(folder)

A write has two phases.  Tasks write into a staging folder of the job, each file
under a name of its own that is then renamed, so repeated and speculative
attempts leave whole files.  Only when every task has ended well does the driver
publish:

* ``overwrite`` stages a whole new folder beside the old one and swaps the two by
  renaming, whatever the number of files; readers find the old set or the new
  one.  If the driver is lost between the two renames, ``recover`` puts the old
  folder back; the next write calls it (readers do not: the writer may be alive).
* ``append`` and streams move the files of the attempts that committed into the
  folder, replacing files of the same name (same id later -> later content wins).
  A replayed batch moves the same files again.

A job that fails removes its staging folder and leaves the folder as it was.
Paths go through ``pyarrow.fs``: local, a shared mount, HDFS or an object store
(where renaming a folder copies it).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

FORMAT_NAME = "frame_files"
#: Counts of the last write; readers skip names that start with an underscore.
COUNTS_NAME = "_counts.json"
SCHEMA = "file_name string, content binary"


def _filesystem(path: str):
    # Same as tessera.session.filesystem_for, kept here on purpose: this
    # module is shipped to executors by value and must not import the package.
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    for scheme in ("s3a://", "s3n://"):  # the names Spark uses for the same store
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme):]
    return fs.FileSystem.from_uri(path)


@dataclass
class FilesWritten(WriterCommitMessage):
    count: int
    skipped: int
    folder: str


def _beside(root: str, kind: str, job: str) -> str:
    """A hidden folder next to ``root``."""
    parent, _, name = root.rstrip("/").rpartition("/")
    return f"{parent}/_{name}.{kind}-{job}"


def _is_there(filesystem, path: str) -> bool:
    from pyarrow import fs

    return filesystem.get_file_info(path).type != fs.FileType.NotFound


def recover(path: str) -> None:
    """Finish a swap that a lost driver left half done: without a folder the set
    aside one comes back, beside a published folder it goes."""
    from pyarrow import fs

    filesystem, root = _filesystem(path)
    parent, _, name = root.rstrip("/").rpartition("/")
    for info in filesystem.get_file_info(fs.FileSelector(parent or "/", allow_not_found=True)):
        if info.base_name.startswith(f"_{name}.old-"):
            if _is_there(filesystem, root):
                filesystem.delete_dir(info.path)
            else:
                filesystem.move(info.path, root)


def _write_files(filesystem, folder: str, rows, tag: int) -> tuple[int, int]:
    """Files written and rows skipped."""
    filesystem.create_dir(folder, recursive=True)
    n = skipped = 0
    for row in rows:
        name = row["file_name"]
        if not name or "/" in name or row["content"] is None:
            skipped += 1  # one bad frame does not stop the others
            continue
        tmp = f"{folder}/.{name}.{tag}.tmp"
        try:
            with filesystem.open_output_stream(tmp) as out:
                out.write(bytes(row["content"]))
            filesystem.move(tmp, f"{folder}/{name}")
        except BaseException:
            if _is_there(filesystem, tmp):
                filesystem.delete_file(tmp)
            raise  # the store is at fault: the task is tried again
        n += 1
    return n, skipped


def _attempt() -> int:
    from pyspark import TaskContext

    ctx = TaskContext.get()
    return ctx.taskAttemptId() if ctx else 0  # unique within the application, over stage attempts too


def _save_counts(filesystem, folder: str, messages) -> None:
    import json

    counts = {"saved": sum(m.count for m in messages), "skipped": sum(m.skipped for m in messages)}
    with filesystem.open_output_stream(f"{folder}/{COUNTS_NAME}") as out:
        out.write(json.dumps(counts).encode())


def _publish(filesystem, root: str, folders: list[str]) -> None:
    """Move all files of ``folders`` into ``root``."""
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import fs

    files = [f for folder in folders for f in filesystem.get_file_info(fs.FileSelector(folder, allow_not_found=True))
             if f.type == fs.FileType.File and not f.base_name.endswith(".tmp")]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda f: filesystem.move(f.path, f"{root}/{f.base_name}"), files))


def _remove(filesystem, folder: str) -> None:
    if _is_there(filesystem, folder):
        filesystem.delete_dir(folder)


class FrameFileWriter(DataSourceWriter):
    """A batch write; made once a job, on the driver."""

    def __init__(self, path: str, overwrite: bool):
        import uuid

        recover(path)
        self.path, self.overwrite, job = path, overwrite, uuid.uuid4().hex
        root = _filesystem(path)[1].rstrip("/")
        self.old, self.staging = _beside(root, "old", job), _beside(root, "stage", job) if overwrite else f"{root}/_stage-{job}"

    def write(self, iterator):
        filesystem, _ = _filesystem(self.path)
        attempt = _attempt()
        folder = self.staging if self.overwrite else f"{self.staging}/{attempt}"
        return FilesWritten(*_write_files(filesystem, folder, iterator, attempt), folder)

    def commit(self, messages) -> None:
        filesystem, root = _filesystem(self.path)
        done = [m for m in messages if m]
        if not self.overwrite:
            filesystem.create_dir(root, recursive=True)
            _publish(filesystem, root, [m.folder for m in done])
            _save_counts(filesystem, root, done)
            _remove(filesystem, self.staging)
            return
        filesystem.create_dir(self.staging, recursive=True)
        _save_counts(filesystem, self.staging, done)
        replaced = _is_there(filesystem, root)
        if replaced:
            filesystem.move(root, self.old)
        try:
            filesystem.move(self.staging, root)
        except BaseException:
            if replaced:
                filesystem.move(self.old, root)
            raise
        _remove(filesystem, self.old)

    def abort(self, messages) -> None:
        _remove(_filesystem(self.path)[0], self.staging)


class FrameFileStreamWriter(DataSourceStreamWriter):
    """A stream's writes: each batch publishes the attempts that its messages name.
    Tasks and commits are made from different copies of this object, so the
    staging folder has a fixed name: one stream writes to a folder at a time."""

    def __init__(self, path: str):
        self.path = path

    def _staging(self, root: str) -> str:
        return f"{root}/_stage-stream"

    def write(self, iterator):
        filesystem, root = _filesystem(self.path)
        attempt = _attempt()
        folder = f"{self._staging(root)}/{attempt}"
        return FilesWritten(*_write_files(filesystem, folder, iterator, attempt), folder)

    def commit(self, messages, batchId: int) -> None:
        filesystem, root = _filesystem(self.path)
        done = [m for m in messages if m]
        filesystem.create_dir(root, recursive=True)
        _publish(filesystem, root, [m.folder for m in done])
        _save_counts(filesystem, root, done)
        _remove(filesystem, self._staging(root))

    def abort(self, messages, batchId: int) -> None:
        filesystem, root = _filesystem(self.path)
        _remove(filesystem, self._staging(root))


class FrameFileDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT_NAME

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> FrameFileWriter:
        path = self.options.get("path")
        if not path:
            raise ValueError("frame_files needs a path")
        return FrameFileWriter(path, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> FrameFileStreamWriter:
        path = self.options.get("path")
        if not path:
            raise ValueError("frame_files needs a path")
        return FrameFileStreamWriter(path)


def register(spark: SparkSession) -> None:
    """Register the data source.  Its writer runs in executor Python workers,
    which may not have this package installed (a cluster, or a driver started
    from another folder), so the module's classes travel by value rather than
    as an import reference."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FrameFileDataSource)


def write_frame_files(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df(file_name string, content binary)`` as one file per row."""
    register(df.sparkSession)
    df.select("file_name", "content").write.format(FORMAT_NAME).mode(mode).save(path)


def saved_counts(path: str) -> dict[str, int]:
    """Frames saved and skipped by the last write to ``path``."""
    import json

    filesystem, root = _filesystem(path)
    with filesystem.open_input_stream(f"{root}/{COUNTS_NAME}") as f:
        return json.loads(f.read())


def read_frame_files(spark: SparkSession, path: str, pattern: str = "frame_*") -> DataFrame:
    """(file_name, length, content) of the files written to ``path``."""
    from pyspark.sql import functions as F

    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return df.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), "length", "content"
    )

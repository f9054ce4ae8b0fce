"""Session construction and shared scratch locations.

Queries never create their own session: they receive one.  ``build_session``
is for tests, the bench and command-line use; on a cluster the platform's
session (with its own ``spark.checkpoint.dir``) is used as is.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that shape every plan.  AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold, otherwise
# sort-merge), splits skewed join partitions, and coalesces small shuffle
# partitions, so the static shuffle-partition count can be sized for the
# largest stage.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture for error messages costs several Python<->JVM round
    # trips per column function while a plan is built; off for batch jobs.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings the plans assume.

    ``master`` defaults to ``local[$BENCH_CPUS]`` (or ``local[*]``), unless the
    process was started by a launcher that has chosen one already.  The
    shuffle-partition count defaults to 2x the local cores; on a cluster set
    it from the data size (about 128 MB per partition of the largest shuffle)
    and let AQE coalesce.
    """
    cpus = os.environ.get("BENCH_CPUS")
    launched = master is None and not cpus and "PYSPARK_GATEWAY_PORT" in os.environ
    if master is None:
        master = f"local[{cpus}]" if cpus else "local[*]"
    if shuffle_partitions is None:
        shuffle_partitions = 2 * (int(cpus) if cpus else (os.cpu_count() or 8))
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_BASE_CONF)
    if not launched:
        builder = builder.master(master)
        conf |= {"spark.driver.bindAddress": "127.0.0.1", "spark.driver.host": "127.0.0.1"}
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    When the setting is absent (a bare local session, as in tests) a fresh
    temporary folder is used and registered; on a cluster the setting must
    name a shared file system, so absence is an error there.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, object store or shared mount) for this cluster"
        )
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    return local


# Scratch folders made by this process.  Their files must outlive the query
# call (the returned DataFrame reads them lazily) but not the process.
_SCRATCH: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root, removed when
    this Python process exits (set ``TESSERA_KEEP_SCRATCH=1`` to keep it)."""
    path = f"{checkpoint_root(spark)}/tessera/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def filesystem_for(path: str):
    """(pyarrow filesystem, path within it) for a local path or URI."""
    from pyarrow import fs

    if "://" not in path:
        path = "file://" + path
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    for scheme in ("s3a://", "s3n://"):  # the names Spark uses for the same store
        if path.startswith(scheme):
            path = "s3://" + path[len(scheme):]
    return fs.FileSystem.from_uri(path)


@atexit.register
def _remove_scratch() -> None:
    if os.environ.get("TESSERA_KEEP_SCRATCH"):
        return
    while _SCRATCH:
        path = _SCRATCH.pop()
        try:
            filesystem, root = filesystem_for(path)
            filesystem.delete_dir(root)
        except Exception:  # already gone, never written, or not reachable
            pass

"""Shared helpers: package shipping, landed tables, clash-free columns."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_dir

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in this application's Python workers.

    The package goes out once per application through Spark's own file
    distribution, so jobs run on executors that have no copy of the
    repository."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import tessera

    root = os.path.dirname(os.path.abspath(tessera.__file__))
    folder = tempfile.mkdtemp(prefix="tessera-ship-")  # on the driver, which hands the file out
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "tessera_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tessera", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def land(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: computed
    once, lineage cut, safe when executors are lost."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))

"""The driver may load __spark_entry__.py by path from any folder, with its
own session; executor-side Python code must not rely on the package being
importable there."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert m.entry(spark).count() > 0
q = m.queries()
assert q["frame_files"](spark, "/root/testdata/sf0.001").count() > 0
print("PORTABLE_OK")
"""


def test_entry_and_executor_code_from_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert "PORTABLE_OK" in out.stdout, out.stderr[-3000:]


CLEANUP_SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from tessera.plans.registry import load_all
from tessera import session
load_all()["json_lines_message"].fn(spark, "/root/testdata/sf0.001").count()
print("SCRATCH", session._SCRATCH[0])
"""


def test_scratch_removed_at_exit(tmp_path):
    out = subprocess.run([sys.executable, "-c", CLEANUP_SCRIPT], cwd=tmp_path, capture_output=True,
                         text=True, timeout=600)
    line = [x for x in out.stdout.splitlines() if x.startswith("SCRATCH ")]
    assert line, out.stderr[-2000:]
    path = line[0].split(" ", 1)[1].replace("file:", "")
    assert not os.path.exists(path)
